import hashlib
import os
import pathlib
import shutil
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import stations
from sunsieve.errors import LoadError, QueryError, TransformError
from sunsieve.operators.align import enforce_schema
from sunsieve.operators.night import zero_at_night
from sunsieve.plans import metrics
from sunsieve.plans.refresh import refresh
from sunsieve.schema import FINAL_SCHEMA, STATION, TIME
from sunsieve.sources import tables
from sunsieve.sources.files import load_readings
from sunsieve.streaming.arrivals import HEADER, arriving, keep_appending


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "rows.csv"
    """The one day of the network that is whole: 96 rows of ten stations."""
    return load_readings(spark, stations.write(path, stations.rows())).where("date(date_time) = '2021-03-10'").cache()


def days(rows, n):
    """The day repeated on n consecutive days, over a month's end."""
    later = F.explode(F.sequence(F.lit(20), F.lit(19 + n))).alias("later")
    moved = rows.select("*", later).withColumn(TIME, F.expr("date_time + make_dt_interval(later)"))
    return enforce_schema(moved)


def test_gold_file_reads_back_equal_and_small(spark, rows, tmp_path):
    path = tables.export_gold(rows, str(tmp_path), "20240101_000000")
    assert path == f"{tmp_path}/gold/pvod_20240101_000000.parquet"
    back = spark.read.parquet(path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in FINAL_SCHEMA]
    assert back.exceptAll(enforce_schema(rows)).isEmpty() and back.count() == 960
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(path) if f.startswith("part"))
    csv = len("\n".join(",".join(r.values()) for r in stations.rows()))
    assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) < csv


def test_run_id_defaults_to_the_utc_second():
    stamp = tables.gold_path("r/").removeprefix("r/gold/pvod_").removesuffix(".parquet")
    assert abs((datetime.now() - datetime.strptime(stamp, "%Y%m%d_%H%M%S")).total_seconds()) < 86_400


def test_load_id_formula(spark):
    found = spark.range(1).select(tables.load_id(*(F.lit(x) for x in ("gs://b/f", "p", "d", "t", "m")))).first()[0]
    assert found == "pvod_load_" + hashlib.md5(b"gs://b/fpdtm").hexdigest()


def test_fingerprint_ignores_order_but_not_content(rows):
    one = tables.fingerprint(rows).first()
    assert tables.fingerprint(rows.orderBy("power").repartition(7)).first() == one
    assert tables.fingerprint(rows.withColumn("power", F.col("power") + 1)).first() != one
    assert tables.fingerprint(rows.union(rows).union(rows)).first() != one


@pytest.mark.parametrize("grain,folders", [("day", 5), ("month", 2)])
def test_partitions_by_grain(spark, rows, tmp_path, grain, folders):
    where = str(tmp_path / "table")
    tables.append_clustered(days(rows, 5), where, grain)
    assert sum(f.startswith(f"{grain}=") for f in os.listdir(where)) == folders
    stored = spark.read.parquet(where)
    assert stored.drop(grain).exceptAll(days(rows, 5)).isEmpty() and stored.count() == 4800
    part = tables.time_range(stored, "2021-03-31 06:00:00", datetime(2021, 4, 1, 6))
    assert part.count() == (96 + 1) * 10


def test_a_range_opens_only_its_partitions(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    tables.append_clustered(days(rows, 5), where)
    part = tables.time_range(spark.read.parquet(where), "2021-03-31", "2021-03-31 23:59:59")
    assert len({r[0] for r in part.select(F.input_file_name()).collect()}) == 1
    scan = next(line for line in part._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(day" in scan and "GreaterThanOrEqual(date_time" in scan
    one, all_days = (metrics.scan_estimate(spark, where, "2021-03-01", end).first() for end in ("2021-03-30", "2021-05-01"))
    assert (one["partitions"], all_days["partitions"]) == (1, 5)
    assert 0 < one["bytes"] < all_days["bytes"]
    assert metrics.scan_estimate(spark, where, "2001-01-01", "2001-01-02").first().asDict() == {"partitions": 0, "files": 0, "bytes": 0}


def test_a_large_day_is_written_by_several_tasks(spark, rows, tmp_path):
    where, size = str(tmp_path / "table"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    many = enforce_schema(rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).repartition(8))
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        tables.append_clustered(many, where)
    finally:
        spark.conf.set(size, before)
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{where}/day=2021-03-10")) > 1
    assert spark.read.parquet(where).count() == 960 * 40


def test_rows_without_a_time_are_stored_and_not_repeated(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    lost = enforce_schema(rows.where("power > 0").limit(1).withColumn(TIME, F.lit(None).cast("timestamp_ntz")))
    for _ in range(2):
        tables.append_new(enforce_schema(rows).union(lost), where)
    assert spark.read.parquet(where).count() == 961


def test_loading_twice_changes_nothing(spark, rows, tmp_path):
    root, where = str(tmp_path), str(tmp_path / "table")
    uri = tables.export_gold(rows, root, "one")
    first = tables.load_once(spark, uri, where, root)
    assert tables.load_once(spark, uri, where, root) == first
    other = tables.export_gold(rows, root, "two")
    assert tables.load_once(spark, other, where, root) != first
    assert spark.read.parquet(where).count() == 960
    assert spark.read.parquet(f"{where}.loads").count() == 2


def test_a_load_that_broke_half_way_is_finished(spark, rows, tmp_path):
    root, where = str(tmp_path), str(tmp_path / "table")
    uri = tables.export_gold(rows, root, "one")
    tables.append_clustered(enforce_schema(rows).where("station_id < 4"), where)
    tables.load_once(spark, uri, where, root)
    stored = spark.read.parquet(where).drop("day")
    assert stored.count() == 960 and stored.exceptAll(enforce_schema(rows)).isEmpty()


def test_loads_outside_the_root_or_of_nothing_fail(spark, tmp_path):
    with pytest.raises(LoadError, match="not below"):
        tables.load_once(spark, "/elsewhere/f.parquet", str(tmp_path / "t"), str(tmp_path))
    with pytest.raises(LoadError, match="failed"):
        tables.load_once(spark, f"{tmp_path}/none.parquet", str(tmp_path / "t"), str(tmp_path))


def test_average_power(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1S, timestamp_ntz'2024-01-01 00:00:00', 1D), (1S, timestamp_ntz'2024-01-01 00:15:00', NULL),"
        " (1S, timestamp_ntz'2024-01-01 00:30:00', 3D), (2S, timestamp_ntz'2024-01-01 00:30:00', NULL),"
        " (0S, timestamp_ntz'2024-01-01 00:45:00', 9D) AS t(station_id, date_time, power)"
    )
    both = "2024-01-01 00:00:00", "2024-01-01 00:30:00"
    for ask in (metrics.average_power, metrics.average_power_sql):
        assert [tuple(r) for r in ask(df, *both).collect()] == [(1, 2.0), (2, None)]
        assert [tuple(r) for r in ask(df, both[1], both[1]).collect()] == [(1, 3.0), (2, None)]
        assert ask(df, both[1], both[0]).isEmpty()
        assert ask(df, datetime(2024, 1, 1, 0, 45), datetime(2025, 1, 1)).first()["avg_power"] == 9.0
    assert metrics.result_total(metrics.average_power(df, *both)).first()["total_rows"] == 2


def test_bound_values_are_not_query_text(spark, rows):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        metrics.average_power_sql(rows, "2018-07-01' OR '1' = '1", "2018-07-02").collect()


def test_table_query_dry_run_and_cap(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    range_ = "2021-03-10", "2021-03-10 23:59:59"
    with pytest.raises(QueryError, match="no table"):
        metrics.query_average_power(spark, where, *range_)
    tables.append_clustered(enforce_schema(rows), where)
    estimate = metrics.query_average_power(spark, where, *range_, dry_run=True).first()["bytes"]
    assert estimate > 0
    assert metrics.query_average_power(spark, where, *range_, max_bytes=estimate).count() == 10
    with pytest.raises(QueryError, match="are allowed"):
        metrics.query_average_power(spark, where, *range_, max_bytes=estimate - 1)


def test_preview_and_counts(rows):
    assert [tuple(r) for r in metrics.preview(rows, 3).select(STATION, F.minute(TIME)).collect()] == [(0, 0), (0, 15), (0, 30)]
    assert [tuple(r) for r in metrics.station_counts(rows).collect()] == [(s, 96) for s in range(10)]


def test_fingerprint_sees_nulls_move_and_pairs_change(spark):
    def of(values):
        return tables.fingerprint(spark.createDataFrame(values, "a double, b double")).first()

    assert of([(1.0, None)]) != of([(None, 1.0)])
    assert of([(1.0, 2.0), (1.0, 2.0), (5.0, 5.0)]) != of([(3.0, 4.0), (3.0, 4.0), (5.0, 5.0)])


def test_other_values_for_known_keys_follow_the_policy(spark, rows, tmp_path):
    root = str(tmp_path)
    changed = rows.withColumn("power", F.when(F.col(STATION) == 2, F.lit(-1.0)).otherwise(F.col("power")))
    uris = [tables.export_gold(df, root, name) for df, name in ((rows, "one"), (changed, "two"))]
    for policy, expected in (("keep", 0), ("replace", 96)):
        where = f"{root}/{policy}"
        for uri in uris:
            tables.load_once(spark, uri, where, root, on_conflict=policy)
        stored = spark.read.parquet(where)
        assert stored.count() == 960 and stored.where("power = -1").count() == expected
    tables.load_once(spark, uris[0], f"{root}/error", root)
    with pytest.raises(LoadError, match="holds 96 keys"):
        tables.load_once(spark, uris[1], f"{root}/error", root)
    assert spark.read.parquet(f"{root}/error.loads").count() == 1


def test_replacing_leaves_other_partitions_alone(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    tables.append_clustered(days(rows, 3), where)
    before = {d: sorted(os.listdir(f"{where}/{d}")) for d in os.listdir(where) if d.startswith("day=")}
    one = days(rows, 1).withColumn("power", F.lit(-1.0))
    tables.append_new(one, where, on_conflict="replace")
    after = {d: sorted(os.listdir(f"{where}/{d}")) for d in before}
    assert [d for d in before if before[d] != after[d]] == ["day=2021-03-30"]
    assert spark.read.parquet(where).where("power = -1").count() == 960


def test_a_table_keeps_its_grain(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    tables.append_clustered(enforce_schema(rows), where, "month")
    for write in (tables.append_clustered, tables.append_new):
        with pytest.raises(LoadError, match="stored by month"):
            write(enforce_schema(rows), where, "day")
    range_ = "2021-03-10", "2021-03-10 23:59:59"
    assert metrics.query_average_power(spark, where, *range_).count() == 10
    with pytest.raises(QueryError, match="stored by month"):
        metrics.scan_estimate(spark, where, *range_, grain="day")


def test_estimates_are_what_a_listing_says(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    tables.append_clustered(days(rows, 3), where)
    sizes = [os.path.getsize(f"{where}/day=2021-03-31/{f}") for f in os.listdir(f"{where}/day=2021-03-31") if f.endswith(".parquet")]
    found = metrics.scan_estimate(spark, where, "2021-03-31", "2021-03-31 12:00:00").first()
    assert tuple(found) == (1, len(sizes), sum(sizes))
    answer = metrics.answer_average_power(spark, where, "2021-03-31", "2021-03-31 12:00:00")
    read = footers(where, metrics.AVERAGE_COLUMNS, ["2021-03-31"])
    assert (answer.total_rows, answer.bytes_processed, len(answer.rows)) == (10, read, 10) and read < sum(sizes)


def test_failures_of_questions_are_query_errors(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    tables.append_clustered(enforce_schema(rows), where)
    with pytest.raises(QueryError, match="failed"):
        metrics.answer_average_power(spark, where, "no date", "2021-03-31")


def test_repeats_in_a_batch_do_not_depend_on_order(spark, rows):
    two = enforce_schema(rows).limit(1)
    other = two.withColumn("power", F.col("power") + 1)
    for pair in (two.union(other), other.union(two).union(two)):
        assert tables.one_per_key(pair, "keep").exceptAll(two).isEmpty()
        with pytest.raises(Exception, match="differ"):
            tables.one_per_key(pair).collect()


def test_a_failed_refresh_is_a_transform_error_and_leaves_nothing_behind(spark, tmp_path):
    path = stations.write(tmp_path / "in.csv", stations.rows({(0, 0): {"power": "many"}}))
    work = tmp_path / "work"
    with pytest.raises(TransformError):
        refresh(spark, [path], str(tmp_path / "out"), str(tmp_path / "table"), work_dir=str(work))
    assert not work.exists() or os.listdir(work) == []


def test_refresh_end_to_end(spark, tmp_path):
    path = stations.write(tmp_path / "in.csv", stations.rows({**stations.NULLS, **stations.OUTLIER}))
    root = str(tmp_path / "out")
    done = refresh(spark, [str(tmp_path / "none.csv"), path], root, f"{root}/table", run_id="r1")
    again = refresh(spark, [path], root, f"{root}/table", run_id="r2")
    assert done.load_id != again.load_id
    stored = spark.read.parquet(f"{root}/table")
    assert stored.count() == stations.ROWS and stored.where("lmd_windspeed < -300 OR lmd_pressure IS NULL").isEmpty()
    told = {r["step"]: r for r in done.metrics.collect()}
    assert list(told) == ["zero_at_night", "hampel", "impute"] and told["impute"]["changed"] == 5
    assert told["hampel"]["changed"] >= 1 and all(r["bytes_written"] > 0 for r in told.values())
    assert done.report.where("check = 'nulls' AND violations = 5").count() == 1


def test_a_refused_refresh_takes_its_file_back(spark, tmp_path):
    root, lines = str(tmp_path / "out"), stations.rows()
    path = stations.write(tmp_path / "in.csv", lines)
    refresh(spark, [path], root, f"{root}/table", run_id="r1", steps=(zero_at_night,))
    other = stations.write(tmp_path / "other.csv", [x | {"nwp_pressure": "1.0"} for x in lines[:50]])
    with pytest.raises(LoadError, match="50 keys"):
        refresh(spark, [other], root, f"{root}/table", run_id="r2", steps=(zero_at_night,))
    assert sorted(os.listdir(f"{root}/gold")) == ["pvod_r1.parquet"]
    assert spark.read.parquet(f"{root}/table").where("nwp_pressure = 1").isEmpty()


def footers(table, columns, days):
    """Bytes of the columns' chunks by every file's footer."""
    total = 0
    for day in days:
        for file in pathlib.Path(table, f"day={day}").glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            chunks = (meta.row_group(g).column(k) for g in range(meta.num_row_groups) for k in range(meta.num_columns))
            total += sum(c.total_compressed_size for c in chunks if c.path_in_schema in columns)
    return total


@pytest.mark.parametrize("columns", [["station_id", "date_time", "power"], ["lmd_pressure"], ["day", "power"]])
def test_estimates_by_column_are_what_the_footers_say(spark, rows, tmp_path, columns):
    where = str(tmp_path / "table")
    tables.append_clustered(rows, where)
    found = metrics.scan_estimate(spark, where, "2021-03-10", "2021-03-10 23:45", columns=columns).first()
    assert (found["partitions"], found["bytes"]) == (1, footers(where, columns, ["2021-03-10"]))
    whole = metrics.scan_estimate(spark, where, "2021-03-10", "2021-03-10 23:45").first()
    assert found["files"] == whole["files"] and 0 < found["bytes"] < whole["bytes"]
    with pytest.raises(QueryError, match="no column"):
        metrics.scan_estimate(spark, where, "2021-03-10", "2021-03-10 23:45", columns=["nothing"])


def test_two_loads_of_one_file_do_not_both_append(spark, rows, tmp_path, monkeypatch):
    root, where = str(tmp_path / "out"), str(tmp_path / "table")
    uri = tables.export_gold(rows, root, "r")
    append, inner = tables.append_new, []

    def meanwhile(*args):  # another loader comes while the first has begun
        if not inner:
            inner.append(True)
            with pytest.raises(LoadError, match="begun"):
                tables.load_once(spark, uri, where, root)
        append(*args)

    monkeypatch.setattr(tables, "append_new", meanwhile)
    one = tables.load_once(spark, uri, where, root)
    assert tables.load_once(spark, uri, where, root) == one
    assert spark.read.parquet(where).count() == rows.count() and spark.read.parquet(f"{where}.loads").count() == 1


def test_an_interrupted_load_is_seen_and_resumed(spark, rows, tmp_path, monkeypatch):
    root, where = str(tmp_path / "out"), str(tmp_path / "table")
    uri = tables.export_gold(rows, root, "r")

    def dies(*args):
        raise KeyboardInterrupt

    append = tables.append_new
    monkeypatch.setattr(tables, "append_new", dies)
    with pytest.raises(KeyboardInterrupt):
        tables.load_once(spark, uri, where, root)
    monkeypatch.setattr(tables, "append_new", append)
    with pytest.raises(LoadError, match="begun"):
        tables.load_once(spark, uri, where, root)
    tables.load_once(spark, uri, where, root, resume=True)
    assert spark.read.parquet(where).count() == rows.count()


def test_a_replacement_that_broke_is_finished_first(spark, rows, tmp_path, monkeypatch):
    where = str(tmp_path / "table")
    tables.append_clustered(rows, where)
    n = rows.count()
    changed = rows.limit(40).withColumn("power", F.lit(-1.0)).cache()
    overwrite = tables.overwrite_partitions

    def breaks(new, table, grain="day"):  # the old files are gone, the new ones not yet there
        for day in pathlib.Path(table).glob("day=*"):
            shutil.rmtree(day)
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "overwrite_partitions", breaks)
    with pytest.raises(RuntimeError):
        tables.append_new(changed, where, on_conflict="replace")
    monkeypatch.setattr(tables, "overwrite_partitions", overwrite)
    others = spark.read.parquet(where) if any(pathlib.Path(where).glob("day=*")) else None
    assert others is None or others.count() < n
    with pytest.raises(LoadError, match="broke"):
        tables.read_table(spark, where)
    tables.append_new(changed.limit(1), where, on_conflict="replace")
    stored = tables.read_table(spark, where)
    touched = {str(d) for (d,) in rows.select(F.col("date_time").cast("date")).distinct().collect()}
    assert stored.where("power = -1").count() == 40
    assert stored.join(changed.select(F.col("date_time").cast("date").alias("day")).distinct(), "day", "left_semi").count() > 40
    assert {p.name for p in tmp_path.iterdir()} == {"table"} and touched


def test_the_kept_fingerprint_is_that_of_the_whole(spark, rows, tmp_path, monkeypatch):
    where = str(tmp_path / "table")

    def same():
        whole = tables.fingerprint(spark.read.parquet(where).drop("day")).first()
        assert tables.kept_fingerprint(spark, where).first() == whole

    some = rows.where("station_id < 4")
    tables.append_new(some, where)
    same()
    tables.append_new(rows.where("station_id >= 4 AND hour(date_time) < 12"), where)
    same()
    read = []
    summed = tables.partition_sums
    monkeypatch.setattr(tables, "partition_sums", lambda df, grain: read.append(df) or summed(df, grain))
    tables.append_new(rows.limit(5).withColumn("power", F.lit(9.5)), where, on_conflict="replace")
    same()
    assert len(read) == 1 and read[0].select("day").distinct().count() <= 5
    read.clear()
    same()
    assert not read  # nothing was touched
    timeless = rows.limit(1).withColumn("date_time", F.lit(None).cast("timestamp_ntz"))
    tables.append_new(timeless, where)
    same()


def test_arrivals_enter_once(spark, tmp_path):
    inbox, where = tmp_path / "inbox", str(tmp_path / "table")
    inbox.mkdir()
    lines = stations.rows()
    stations.write(inbox / "a.csv", lines[:200] + lines[:5], HEADER)

    def follow(checkpoint="mark"):
        keep_appending(arriving(spark, str(inbox)), where, str(tmp_path / checkpoint)).awaitTermination()
        return spark.read.parquet(where)

    assert follow().count() == 200
    stations.write(inbox / "b.csv", lines[150:], HEADER)
    assert follow().count() == stations.ROWS
    assert follow("other").count() == stations.ROWS
    assert follow().where("hour(date_time) = 0 AND power <> 0").isEmpty()


def test_many_small_arrivals_of_a_day_become_few_files(spark, rows, tmp_path):
    where = str(tmp_path / "table")
    two = days(rows, 2)
    tables.append_clustered(two.where("day(date_time) = 31"), where)
    for station in range(5):
        tables.append_clustered(two.where(f"day(date_time) = 30 AND station_id % 5 = {station}"), where)

    def files(day):
        return sorted(p.name for p in pathlib.Path(where, f"day=2021-03-{day}").glob("*.parquet"))

    whole, other = tables.fingerprint(spark.read.parquet(where)).first(), files(31)
    assert len(files(30)) >= 5
    told = tables.compact(spark, where).collect()
    assert [(str(r["day"]), r["files"] >= 5) for r in told] == [("2021-03-30", True)]
    assert len(files(30)) <= 2 and files(31) == other
    assert tables.fingerprint(spark.read.parquet(where)).first() == whole
    assert tables.compact(spark, where).isEmpty()
