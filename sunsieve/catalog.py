"""The registered queries: every operator, run over the whole given tables.

The tables hold no station readings, so `readings` gives `events` that shape: one
row per station and 15-minute cell, with holes, nulls and outliers.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunsieve.errors import LoadError, QueryError
from sunsieve.functions.grid import floor_to_grid, off_grid, parse_time
from sunsieve.functions.solar import is_night, solar_elevation
from sunsieve.functions.values import blank_tokens
from sunsieve.operators import checks
from sunsieve.operators.align import align_join, align_join_asof, enforce_schema, on_grid, union_all, with_deltas
from sunsieve.operators.clearsky import impute_irradiance
from sunsieve.operators.hampel import hampel, rolling_mad, rolling_median
from sunsieve.operators.impute import backward_fill, forward_fill, impute, interpolate
from sunsieve.operators.night import zero_at_night
from sunsieve.operators.spline import impute_spline
from sunsieve.plans import metrics
from sunsieve.plans.clean import STEPS, Step, clean, stage_metrics
from sunsieve.plans.refresh import Refreshed, refresh
from sunsieve.schema import FINAL_TYPES, IRRADIANCE, MEASURES, STATION, TIME, WIND
from sunsieve.sources import files, tables
from sunsieve.sources.shared import shared_folder
from sunsieve.streaming.arrivals import keep_appending, reclean

Query = Callable[[SparkSession, str], DataFrame]

WHOLE = ("0001-01-01 00:00:00", "9999-12-31 23:59:59")
SOME_DAYS = ("2024-01-05 06:00:00", "2024-01-20 18:00:00")

# What each input column takes from an event: a condition and a value.
_PARTS = {
    "nwp_globalirrad": "max(CASE WHEN event_type = 'view' THEN value END)",
    "nwp_directirrad": "max(CASE WHEN event_type = 'purchase' THEN value END)",
    "nwp_temperature": "max(CASE WHEN event_type = 'error' THEN value END)",
    "nwp_humidity": "CAST(max(event_id % 101) AS DOUBLE)",
    "nwp_windspeed": "max(value)",
    "nwp_winddirection": "CAST(max(user_id % 360) AS DOUBLE)",
    "nwp_pressure": "CAST(1000 + max(event_id % 37) AS DOUBLE)",
    "lmd_totalirrad": "max(CASE WHEN event_type = 'click' THEN value END)",
    "lmd_diffuseirrad": "max(CASE WHEN event_type = 'signup' THEN value END)",
    "lmd_temperature": "max(CASE WHEN event_type IN ('error', 'view') THEN value END)",
    "lmd_pressure": "CAST(1000 + min(event_id % 37) AS DOUBLE)",
    "lmd_winddirection": "CAST(min(user_id % 360) AS DOUBLE)",
    "lmd_windspeed": "min(value)",
    "power": "max(CASE WHEN event_type <> 'error' THEN value END)",
}


def time_text(name: str) -> Column:
    """A zone-less time as text, whole, whatever the session zone."""
    return F.col(name).cast("timestamp_ntz").cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a station and their time as read."""
    station = (F.col("user_id") % 10).cast("smallint").alias(STATION)
    return table(spark, sf_dir, "events").select("*", station, F.col("ts").alias(TIME))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = on_grid(events(spark, sf_dir)).groupBy(STATION, TIME)
    return cells.agg(*(F.expr(part).alias(c) for c, part in _PARTS.items()))


def series_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many series: daily quantities of each supplier, with nulls."""
    lines = table(spark, sf_dir, "lineitem")
    most = F.max("l_quantity")
    return lines.groupBy(F.col("l_suppkey").alias(STATION), F.col("l_shipdate").alias(TIME)).agg(
        F.when(most % 7 != 0, most).alias("power"), F.min("l_quantity").alias("nwp_windspeed")
    )


def row_count_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract against the count that the events themselves say, and against one more."""
    rows = readings(spark, sf_dir)
    cells = on_grid(events(spark, sf_dir)).select(STATION, TIME).distinct().count()
    return checks.row_count(rows, cells).union(checks.row_count(rows, cells + 1))


def _feed(spark: SparkSession, sf_dir: str, event_type: str, name: str) -> DataFrame:
    rows = on_grid(events(spark, sf_dir).where(F.col("event_type") == event_type))
    return rows.groupBy(STATION, TIME).agg(F.max("value").alias(name))


def _join(how: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        forecast = _feed(spark, sf_dir, "view", "forecast")
        return align_join(forecast, _feed(spark, sf_dir, "click", "measured"), how)

    return run


def joined_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views with the nearest click at or before them, of half an hour; both at their own times."""

    def feed(event_type: str, name: str) -> DataFrame:
        rows = events(spark, sf_dir).where(F.col("event_type") == event_type)
        return rows.groupBy(STATION, F.col(TIME).cast("timestamp_ntz").alias(TIME)).agg(F.max("value").alias(name))

    return align_join_asof(feed("view", "forecast"), feed("click", "measured"), 30, chunk_days=2)


def _on_readings(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(readings(spark, sf_dir))


def avg_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.average_power(readings(spark, sf_dir), *WHOLE)
    return found.withColumn("avg_power", F.round("avg_power", 6))


def avg_power_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.average_power_sql(readings(spark, sf_dir), *SOME_DAYS)
    return found.withColumn("avg_power", F.round("avg_power", 6))


def result_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.result_total(metrics.average_power(readings(spark, sf_dir), *WHOLE))


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(
        "CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN 'null' WHEN 3 THEN 'NaN' "
        "ELSE CAST(value AS STRING) END"
    )
    return events(spark, sf_dir).select("event_id", blank_tokens(text).cast("double").alias("value"))


def parse_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = events(spark, sf_dir).select("event_id", parse_time(time_text("ts")).alias("parsed"))
    return parsed.withColumn("floored", floor_to_grid(F.col("parsed")))


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_deltas(readings(spark, sf_dir)).drop(*MEASURES)


def final_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce_schema(with_deltas(readings(spark, sf_dir)).withColumn("_extra", F.lit(1)))


def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(on_grid(events(spark, sf_dir)), ["user_id", TIME])


def offgrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.off_grid_times(events(spark, sf_dir))


def offgrid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    return rows.where(off_grid(F.col(TIME))).groupBy(STATION).agg(F.count("*").alias("n_rows"))


def _strong(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c) * 5 for c in IRRADIANCE})


def irradiance_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.irradiance_bounds(_strong(readings(spark, sf_dir)))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.quality_report(_strong(readings(spark, sf_dir)))


def solar(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id", F.round(solar_elevation(time), 9).alias("elevation"), is_night(time).alias("night")
    )


# One row per day and supplier: 4096 days are 4096 rows at most.
DAILY_CHUNK = 4096


def impute_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute(series_by_supplier(spark, sf_dir), chunk_days=DAILY_CHUNK)


def hampel_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hampel(series_by_supplier(spark, sf_dir), ["power", "nwp_windspeed"], chunk_days=DAILY_CHUNK)


def irradiance_by_sky(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = impute_irradiance(readings(spark, sf_dir).select(STATION, TIME, *IRRADIANCE))
    return found.withColumns({c: F.round(c, 6) for c in IRRADIANCE})


def splined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute_spline(readings(spark, sf_dir).select(STATION, TIME, "power", *IRRADIANCE), ["power", *IRRADIANCE])


def hampel_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outliers of some ten days around each row."""
    return hampel(readings(spark, sf_dir).select(STATION, TIME, *WIND), window=1_001, chunk_days=4)


def load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(F.lit("gold/"), F.col("o_orderkey").cast("string"), F.lit(".parquet"))
    found = tables.load_id(uri, F.lit("p"), F.lit("d"), F.col("o_orderpriority"), F.md5("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("load_id"))


def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, p: str) -> DataFrame:
        key = F.lit(name).alias("kind")
        return table(spark, sf_dir, name).select(
            key, F.col(f"{p}_name").alias("name"), F.col(f"{p}_acctbal").alias("balance")
        )

    return union_all([part("supplier", "s"), part("customer", "c")])


def fallback_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [f"{sf_dir}/events_elsewhere.parquet", f"{sf_dir}/events.parquet"]
    found = files.read_first_available(spark, sources, lambda s, path: s.read.parquet(path))
    return found.select("event_id", "ts", "user_id", "event_type", "value")


STATION_FILE = "file=station{:02d}.csv"


def _station_files(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "stations")
    name = F.format_string("station%02d.csv", F.col(STATION))
    rows = readings(spark, sf_dir).select(time_text(TIME).alias(TIME), *MEASURES, name.alias("file"))
    rows.write.partitionBy("file").option("header", True).csv(folder)
    return folder


def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station files written from the readings, then read as one table and loaded."""
    text = files.consolidate(spark, _station_files(spark, sf_dir), file_name=STATION_FILE)
    return files.aligned(files.parsed(text))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "csv")
    files.write_csv(readings(spark, sf_dir), path)
    return files.load_readings(spark, path)


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "published")
    return spark.read.parquet(tables.export_gold(with_deltas(readings(spark, sf_dir)), root, "run"))


def _published(spark: SparkSession, sf_dir: str, grain: str) -> str:
    where = shared_folder(spark, "table")
    tables.append_clustered(enforce_schema(with_deltas(readings(spark, sf_dir))), where, grain)
    return where


def range_from_table(grain: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = spark.read.parquet(_published(spark, sf_dir, grain))
        return tables.time_range(stored, *SOME_DAYS)

    return run


def avg_power_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = _published(spark, sf_dir, tables.DAY)
    found = metrics.query_average_power(spark, where, *SOME_DAYS, max_bytes=2**50)
    return found.withColumn("avg_power", F.round("avg_power", 6))


def scan_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.scan_estimate(spark, _published(spark, sf_dir, tables.DAY), *SOME_DAYS)


def scan_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates by column: those of single columns add up to that of all, which whole files exceed."""
    where = _published(spark, sf_dir, tables.DAY)
    every, part = (metrics.scan_estimate(spark, where, *SOME_DAYS, columns=list(c)).first() for c in (FINAL_TYPES, metrics.AVERAGE_COLUMNS))
    single = sum(metrics.scan_estimate(spark, where, *SOME_DAYS, columns=[c]).first()["bytes"] for c in metrics.AVERAGE_COLUMNS)
    whole = metrics.scan_estimate(spark, where, *SOME_DAYS).first()
    row = (every["partitions"], part["bytes"] == single, part["bytes"] < every["bytes"] < whole["bytes"], every["files"] == whole["files"])
    return spark.createDataFrame([row], "partitions long, adds_up boolean, less boolean, same_files boolean")


def scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the estimate that does not depend on how files are cut."""
    return scan_estimate(spark, sf_dir).select("partitions")


def _kept(one: DataFrame, other: DataFrame, case: str) -> DataFrame:
    both = tables.fingerprint(one).union(tables.fingerprint(other))
    same = (F.min("n_rows") == F.max("n_rows")) & (F.min("content") == F.max("content"))
    return both.agg(F.lit(case).alias("case"), F.max("n_rows").alias("n_rows"), same.alias("same"))


def fingerprint_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether content has its fingerprint after changes that should keep it and changes that should not."""
    rows = enforce_schema(with_deltas(readings(spark, sf_dir)))
    stored = spark.read.parquet(_published(spark, sf_dir, tables.MONTH)).drop(tables.MONTH)
    first = F.col("event_id") == 0
    lines = events(spark, sf_dir).select("event_id", F.col("value").alias("a"), F.lit(None).cast("double").alias("b"))
    moved = lines.select("event_id", F.when(~first, F.col("a")).alias("a"), F.when(first, F.col("a")).alias("b"))
    pairs = [lines.where(F.col("event_id") == k) for k in (1, 2)]
    twice = [lines.unionByName(pair).unionByName(pair) for pair in pairs]
    cases = [
        _kept(rows, stored, "clustered and read again"),
        _kept(lines, lines.orderBy(F.desc("a")).repartition(7), "reordered"),
        _kept(lines, moved, "null moved"),
        _kept(twice[0], twice[1], "pair swapped"),
        _kept(lines, lines.withColumn("a", F.when(first, F.col("a") + 1).otherwise(F.col("a"))), "one value changed"),
    ]
    return union_all(cases)


def fingerprint_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint from kept sums beside that of the whole: after a load, an append, a replacement and a compaction."""
    where = shared_folder(spark, "table")
    rows = enforce_schema(with_deltas(readings(spark, sf_dir)))
    early, changed = rows.where(F.col(TIME) < tables.moment(SOME_DAYS[1])), rows.where(F.minute(TIME) == 0)
    cases = []
    for case, step in (
        ("loaded", lambda: tables.append_new(early, where)),
        ("appended", lambda: tables.append_new(rows, where)),
        ("replaced", lambda: tables.append_new(changed.withColumn("power", F.lit(-7.0)), where, on_conflict="replace")),
        ("compacted", lambda: tables.compact(spark, where, 1)),
    ):
        step()
        kept, whole = tables.kept_fingerprint(spark, where).first(), tables.fingerprint(spark.read.parquet(where).drop(tables.DAY)).first()
        cases.append((case, kept["n_rows"], kept == whole))
    return spark.createDataFrame(cases, "case string, n_rows long, same boolean")


def _loaded_twice(spark: SparkSession, sf_dir: str, on_conflict: str) -> tuple[str, bool]:
    """Whether the second load was refused: a table that has been given the readings, and a file with other power on the hour and new rows."""
    root, where = shared_folder(spark, "published"), shared_folder(spark, "table")
    rows = with_deltas(readings(spark, sf_dir))
    early = rows.where(F.col(TIME) < tables.moment(SOME_DAYS[1]))
    tables.load_once(spark, tables.export_gold(early, root, "first"), where, root)
    power = F.when(F.minute(TIME) == 0, F.lit(-7.0)).otherwise(F.col("power"))
    second = tables.export_gold(rows.withColumn("power", power), root, "second")
    try:
        tables.load_once(spark, second, where, root, on_conflict=on_conflict)
        refused = False
    except LoadError:
        refused = True
    return where, refused


def load_policy(on_conflict: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(_loaded_twice(spark, sf_dir, on_conflict)[0]).drop(tables.DAY)

    return run


def load_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with other values is refused, and the table stays as it was."""
    where, refused = _loaded_twice(spark, sf_dir, "error")
    return spark.read.parquet(where).agg(F.count("*").alias("n_rows"), F.lit(refused).alias("refused"))


def csv_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of events written and read again, to the second and beyond."""
    path = shared_folder(spark, "csv")
    files.write_csv(events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")), path)
    text = files.read_csv(spark, path)
    return text.select(F.col("event_id").cast("bigint").alias("event_id"), parse_time(F.col("ts")).alias("ts"))


def custom_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a caller among the built-in ones: one moves time over many pieces, one renumbers stations."""

    def later(df: DataFrame) -> DataFrame:
        return df.withColumn(TIME, F.expr(f"{TIME} + make_dt_interval(5, 7)"))

    def renumbered(df: DataFrame) -> DataFrame:
        return df.withColumn(STATION, (F.lit(9) - F.col(STATION)).cast("smallint"))

    return clean(readings(spark, sf_dir), [zero_at_night, later, hampel, renumbered, impute], chunk_days=1)


def fallback_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of station files in order of preference, the first of them empty."""
    folder = _station_files(spark, sf_dir)
    text = files.read_first_available(
        spark, [shared_folder(spark, "nowhere"), folder], lambda s, path: files.consolidate(s, path, file_name=STATION_FILE)
    )
    return files.aligned(files.parsed(text))


def cap_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query over a table, asked under a cap it passes and under one byte less than it needs."""
    where = _published(spark, sf_dir, tables.DAY)
    size = metrics.scan_estimate(spark, where, *SOME_DAYS, columns=metrics.AVERAGE_COLUMNS).first()["bytes"]
    rows = []
    for spare in (0, -1):
        try:
            answer = metrics.answer_average_power(spark, where, *SOME_DAYS, max_bytes=size + spare)
            rows.append((spare, False, answer.total_rows, answer.bytes_processed == size))
        except QueryError:
            rows.append((spare, True, None, None))
    return spark.createDataFrame(rows, "spare int, refused boolean, total_rows long, whole boolean")


def _refreshed(spark: SparkSession, sf_dir: str, steps: Sequence[Step] = STEPS) -> Refreshed:
    path, root = shared_folder(spark, "csv"), shared_folder(spark, "out")
    late = F.when(F.col("station_id") == 3, F.expr(f"{TIME} + make_dt_interval(0, 0, 4)")).otherwise(F.col(TIME))
    files.write_csv(readings(spark, sf_dir).withColumn(TIME, late), path)
    return refresh(spark, [path], root, f"{root}/table", run_id="run", steps=steps)


def refresh_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh reports of its input: times off the grid too, though it floors them."""
    return _refreshed(spark, sf_dir).report


def refresh_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh tells of its steps: of the usual ones, and of others with a caller's among them."""

    def without_nights(df: DataFrame) -> DataFrame:
        return df.where(~is_night(F.col(TIME)))

    told = []
    for case, steps in (("usual", STEPS), ("other", (zero_at_night, without_nights, forward_fill))):
        metrics = _refreshed(spark, sf_dir, steps).metrics
        told.append(metrics.select(F.lit(case).alias("case"), "*", (F.col("bytes_written") > 0).alias("wrote")).drop("bytes_written"))
    return union_all(told)


def _long_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with a hole of sixty days, nulls across it, and a row without a time for each station."""
    rows = readings(spark, sf_dir)
    late, gap = F.col(TIME) >= tables.moment("2024-01-16"), F.col(TIME).between(tables.moment("2024-01-05"), tables.moment("2024-01-25"))
    timeless = rows.groupBy(STATION).agg(F.lit(None).cast("timestamp_ntz").alias(TIME), *(F.max(c).alias(c) for c in MEASURES))
    rows = rows.withColumns(
        {
            TIME: F.when(late, F.expr(f"{TIME} + make_dt_interval(60)")).otherwise(F.col(TIME)),
            "lmd_temperature": F.when(~gap, F.col("lmd_temperature")),
        }
    )
    return with_deltas(rows.unionByName(timeless))


def arrivals_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that arrive in three batches out of order, cleaned again where they reach: as if all came at once."""
    raw, cleaned = shared_folder(spark, "raw"), shared_folder(spark, "cleaned")
    rows = _long_readings(spark, sf_dir)
    for part in (1, 0, 2):
        batch = rows.where(F.pmod(F.coalesce(F.unix_date(F.col(TIME).cast("date")), F.lit(0)), F.lit(3)) == part)
        tables.append_new(tables.one_per_key(batch), raw)
        reclean(raw, cleaned, batch.select(F.col(TIME).cast("date").alias("day")))
    return spark.read.parquet(cleaned).drop(tables.DAY)


def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file loaded twice, then the same rows under another name."""
    root, where = shared_folder(spark, "published"), shared_folder(spark, "table")
    rows = with_deltas(readings(spark, sf_dir))
    first, again = (tables.export_gold(rows, root, run) for run in ("first", "again"))
    for uri in (first, first, again):
        tables.load_once(spark, uri, where, root)
    return spark.read.parquet(where).drop(tables.DAY)


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to table in one call, the first source missing."""
    path, root = shared_folder(spark, "csv"), shared_folder(spark, "out")
    files.write_csv(readings(spark, sf_dir), path)
    refresh(spark, [f"{path}-elsewhere", path], root, f"{root}/table", run_id="run")
    return spark.read.parquet(f"{root}/table").drop(tables.DAY)


def arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream, dark at night, appended; then the same stream once more."""
    folder = shared_folder(spark, "arrivals")
    shape = table(spark, sf_dir, "events").schema
    lines = spark.readStream.schema(shape).parquet(f"{sf_dir}/events.parquet*")
    rows = lines.select(F.col("user_id").alias(STATION), F.col("ts").alias(TIME), F.col("value").alias("power"))
    for attempt in ("first", "again"):
        stream = zero_at_night(rows, ["power"])
        keep_appending(stream, f"{folder}/table", f"{folder}/{attempt}").awaitTermination()
    return spark.read.parquet(f"{folder}/table").drop(tables.DAY)


def _rolled(step) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = readings(spark, sf_dir).select(STATION, TIME, *WIND, "nwp_globalirrad")
        return step(rows, [*WIND, "nwp_globalirrad"])

    return run


def queries() -> dict[str, Query]:
    return {
        "avg_power": avg_power,
        "avg_power_bound": avg_power_bound,
        "avg_power_capped": avg_power_capped,
        "result_total": result_total,
        "range_filter": _on_readings(lambda df: tables.time_range(df, *SOME_DAYS)),
        "range_from_days": range_from_table(tables.DAY),
        "range_from_months": range_from_table(tables.MONTH),
        "station_counts": _on_readings(metrics.station_counts),
        "row_count_check": _on_readings(checks.row_count),
        "row_count_met": row_count_met,
        "sample_topk": _on_readings(metrics.preview),
        "scan_estimate": scan_estimate,
        "scan_partitions": scan_partitions,
        "scan_columns": scan_columns,
        "fallback_source": fallback_source,
        "consolidate": consolidated,
        "csv_roundtrip": csv_roundtrip,
        "gold_roundtrip": gold_roundtrip,
        "null_tokens": null_tokens,
        "parse_floor": parse_floor,
        "deltas": deltas,
        "enforce_schema": final_rows,
        "dup_keys": dup_keys,
        "offgrid": offgrid,
        "offgrid_rows": offgrid_rows,
        "irradiance_bounds": irradiance_bounds,
        "null_counts": _on_readings(checks.null_counts),
        "quality_report": quality_report,
        "gaps": _on_readings(checks.gaps),
        "solar_elevation": solar,
        "night_zero": _on_readings(zero_at_night),
        "rolling_median": _rolled(rolling_median),
        "rolling_mad": _rolled(rolling_mad),
        "hampel": _on_readings(hampel),
        "hampel_many_series": hampel_many,
        "hampel_wide": hampel_wide,
        "ffill": _on_readings(forward_fill),
        "bfill": _on_readings(backward_fill),
        "interpolate": _on_readings(interpolate),
        "impute": _on_readings(impute),
        "impute_many_series": impute_many,
        "impute_irradiance": irradiance_by_sky,
        "impute_spline": splined,
        "clean_series": _on_readings(lambda df: clean(with_deltas(df))),
        "clean_fresh_deltas": _on_readings(lambda df: clean(with_deltas(df), recompute_deltas=True)),
        "clean_metrics": _on_readings(stage_metrics),
        "refresh": refreshed,
        "arrivals": arrived,
        "load_id": load_ids,
        "fingerprint": _on_readings(tables.fingerprint),
        "fingerprint_changes": fingerprint_changes,
        "fingerprint_kept": fingerprint_kept,
        "load_keep": load_policy("keep"),
        "load_replace": load_policy("replace"),
        "load_conflicts": load_conflicts,
        "csv_seconds": csv_seconds,
        "clean_custom_step": custom_steps,
        "clean_daily_pieces": _on_readings(lambda df: clean(with_deltas(df), chunk_days=1)),
        "fallback_stations": fallback_stations,
        "cap_refused": cap_refused,
        "refresh_report": refresh_report,
        "refresh_metrics": refresh_metrics,
        "arrivals_cleaned": arrivals_cleaned,
        "idempotent_append": idempotent_append,
        "align_join": _join("inner"),
        "align_join_left": _join("left"),
        "align_join_full": _join("full"),
        "align_join_asof": joined_asof,
        "union_stations": union_feeds,
    }
