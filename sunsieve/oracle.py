"""The registered queries as SQL for another engine, over the same tables."""

from sunsieve.catalog import _PARTS, SOME_DAYS, WHOLE
from sunsieve.schema import DELTAS, FINAL_TYPES, IRRADIANCE, MEASURES, NIGHT_ZERO, WIND

_CELL = "time_bucket(INTERVAL 15 MINUTE, ts)"
_STATION = "CAST(user_id % 10 AS SMALLINT)"
_ALL = ["station_id", "date_time", *MEASURES]
_ORDERED = "PARTITION BY station_id ORDER BY date_time NULLS FIRST"
_BACKWARDS = "PARTITION BY station_id ORDER BY date_time DESC NULLS LAST"

READINGS = (
    f"readings AS (SELECT {_STATION} AS station_id, {_CELL} AS date_time, "
    + ", ".join(f"{part} AS {c}" for c, part in _PARTS.items())
    + " FROM events GROUP BY 1, 2)"
)

SUPPLIERS = (
    "suppliers AS (SELECT l_suppkey AS station_id, l_shipdate AS date_time, "
    "CASE WHEN max(l_quantity) % 7 <> 0 THEN max(l_quantity) END AS power, "
    "min(l_quantity) AS nwp_windspeed FROM lineitem GROUP BY 1, 2)"
)


def _with(*steps: str, last: str) -> str:
    return f"WITH {', '.join(steps)} {last}"


def _from_readings(columns: str, rest: str = "") -> str:
    return _with(READINGS, last=f"SELECT {columns} FROM readings {rest}")


def _elevation(ts: str) -> str:
    declination = f"(radians(23.45) * sin(2.0 * pi() / 365.0 * (284.0 + dayofyear({ts}))))"
    angle = f"(radians(15.0) * ((hour({ts}) + minute({ts}) / 60.0) - 12.0))"
    return (
        f"asin(sin(radians(38.0)) * sin{declination} "
        f"+ cos(radians(38.0)) * cos{declination} * cos{angle})"
    )


def _night(name: str, source: str, columns: list[str]) -> str:
    picked = ", ".join(
        f"CASE WHEN {_elevation('date_time')} <= 0 THEN 0.0::DOUBLE ELSE {c} END AS {c}" if c in NIGHT_ZERO else c
        for c in columns
    )
    return f"{name} AS (SELECT {picked} FROM {source})"


def _mid(column: str, half: int = 2) -> str:
    return f"median({column}) OVER ({_ORDERED} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)"


def _deviations(name: str, source: str, wind, half: int = 2) -> list[str]:
    med = ", ".join(f"{_mid(c, half)} AS med_{c}" for c in wind)
    dev = ", ".join(f"abs({c} - med_{c}) AS dev_{c}" for c in wind)
    mad = ", ".join(f"greatest({_mid(f'dev_{c}', half)}, 1e-10) AS mad_{c}" for c in wind)
    return [
        f"{name}_m AS (SELECT *, {med} FROM {source})",
        f"{name}_d AS (SELECT *, {dev} FROM {name}_m)",
        f"{name}_a AS (SELECT *, {mad} FROM {name}_d)",
    ]


def _is_outlier(c: str) -> str:
    return f"dev_{c} > (3.0::DOUBLE * 1.4826::DOUBLE) * mad_{c}"


def _hampel(name: str, source: str, columns: list[str], wind=WIND, extra: str = "", half: int = 2) -> list[str]:
    picked = ", ".join(
        f"CASE WHEN {_is_outlier(c)} THEN med_{c} ELSE {c} END AS {c}" if c in wind else c for c in columns
    )
    return [*_deviations(name, source, wind, half), f"{name} AS (SELECT {picked}{extra} FROM {name}_a)"]


def _fill(name: str, source: str, columns: list[str], measures, how: str) -> list[str]:
    up = f"{_ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    down = f"{_BACKWARDS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    near = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER ({up}) AS p_{c}, "
        f"last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({up}) AS pr_{c}, "
        f"last_value({c} IGNORE NULLS) OVER ({down}) AS n_{c}, "
        f"last_value(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({down}) AS nr_{c}"
        for c in measures
    )

    def filled(c: str) -> str:
        line = f"CASE WHEN {c} IS NULL THEN p_{c} + (rn - pr_{c}) * ((n_{c} - p_{c}) / (nr_{c} - pr_{c})) END"
        choice = {
            "interpolate": line,
            "ffill": f"p_{c}",
            "bfill": f"n_{c}",
            "impute": f"{line}, p_{c}, n_{c}",
        }[how]
        return f"coalesce({c}, {choice}) AS {c}"

    picked = ", ".join(filled(c) if c in measures else c for c in columns)
    return [
        f"{name}_r AS (SELECT *, row_number() OVER ({_ORDERED}) AS rn FROM {source})",
        f"{name}_n AS (SELECT *, {near} FROM {name}_r)",
        f"{name} AS (SELECT {picked} FROM {name}_n)",
    ]


def _by_sky() -> str:
    """Gaps of irradiance filled along the clear-sky index of the rows of daylight."""
    shares = ", ".join(f"{c} / sky AS {c}" for c in IRRADIANCE)
    near = _fill("filled", "share", ["station_id", "date_time", "sky", *IRRADIANCE], IRRADIANCE, "impute")
    given = ", ".join(
        f"round(coalesce(r.{c}, CASE WHEN f.sky IS NULL THEN 0.0::DOUBLE WHEN f.{c} * f.sky > 1361.0 THEN 1361.0::DOUBLE ELSE f.{c} * f.sky END), 6) AS {c}"
        for c in IRRADIANCE
    )
    return _with(
        READINGS,
        f"high AS (SELECT *, sin({_elevation('date_time')}) AS height FROM readings)",
        "lit AS (SELECT *, CASE WHEN height > 0 THEN 1098.0::DOUBLE * height * exp(-0.059::DOUBLE / height) ELSE 0.0::DOUBLE END AS sky FROM high)",
        f"share AS (SELECT station_id, date_time, sky, {shares} FROM lit WHERE sky >= 1.0)",
        *near,
        last=f"SELECT r.station_id, r.date_time, {given} FROM readings r LEFT JOIN filled f USING (station_id, date_time)",
    )


def _delta_list() -> str:
    return ", ".join(f"{nwp} - {lmd} AS {name}" for name, (nwp, lmd) in DELTAS.items())


_FINAL = f"final AS (SELECT {', '.join(_ALL)}, {_delta_list()} FROM readings)"
_FINAL_COLUMNS = [*_ALL, *DELTAS]

_LONG = (
    "long AS (SELECT * REPLACE (CASE WHEN date_time >= TIMESTAMP '2024-01-16' THEN date_time + INTERVAL 60 DAY "
    "ELSE date_time END AS date_time, CASE WHEN date_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' "
    "THEN NULL ELSE lmd_temperature END AS lmd_temperature) FROM readings "
    f"UNION ALL SELECT station_id, NULL, {', '.join(f'max({c})' for c in MEASURES)} FROM readings GROUP BY station_id)"
)


def _clean(source_columns: list[str], source: str) -> list[str]:
    return [
        _night("night", source, source_columns),
        *_hampel("calm", "night", source_columns),
        *_fill("clean", "calm", source_columns, MEASURES, "impute"),
    ]


def _filled(how: str) -> str:
    return _with(READINGS, *_fill("filled", "readings", _ALL, MEASURES, how), last="SELECT * FROM filled")


def _rows_of_check(check: str, column: str, bad: str, value: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS violations, "
        f"CAST(min({value}) FILTER (WHERE {bad}) AS DOUBLE) AS min_value, "
        f"CAST(max({value}) FILTER (WHERE {bad}) AS DOUBLE) AS max_value FROM {source}"
    )


def _bounds(c: str) -> str:
    return _rows_of_check("bounds", c, f"{c} < 0 OR {c} > 1361", c, "strong")


def _nulls(c: str, source: str) -> str:
    return _rows_of_check("nulls", c, f"{c} IS NULL", c, source)


def _grid(time: str, source: str) -> str:
    return _rows_of_check("off_grid", "date_time", f"minute({time}) NOT IN (0, 15, 30, 45)", f"minute({time})", source)


_STRONG = (
    "strong AS (SELECT * REPLACE ("
    + ", ".join(f"{c} * 5 AS {c}" for c in IRRADIANCE)
    + ") FROM readings)"
)


_QUALITY = " UNION ALL ".join(
    [*(_bounds(c) for c in IRRADIANCE), *(_nulls(c, "strong") for c in MEASURES), _grid("date_time", "strong")]
)


def _loaded(changed: str) -> str:
    columns = ", ".join(f"CASE WHEN {changed} THEN -7.0::DOUBLE ELSE power END AS power" if c == "power" else c for c in FINAL_TYPES)
    return _with(READINGS, _FINAL, last=f"SELECT {columns} FROM final")


def _avg(start: str, end: str) -> str:
    return _from_readings(
        "station_id, round(avg(power), 6) AS avg_power",
        f"WHERE date_time >= TIMESTAMP '{start}' AND date_time <= TIMESTAMP '{end}' GROUP BY station_id ORDER BY 1",
    )


def _between(columns: str) -> str:
    start, end = SOME_DAYS
    return f"SELECT {columns} FROM final WHERE date_time BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"


def _feed(name: str, event_type: str, value: str) -> str:
    return (
        f"{name} AS (SELECT {_STATION} AS station_id, {_CELL} AS date_time, max(value) AS {value} "
        f"FROM events WHERE event_type = '{event_type}' GROUP BY 1, 2)"
    )


def _join(how: str) -> str:
    return _with(
        _feed("f", "view", "forecast"),
        _feed("m", "click", "measured"),
        last=f"SELECT station_id, date_time, forecast, measured FROM f {how} JOIN m USING (station_id, date_time)",
    )


def _stage_metrics() -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in MEASURES)
    outliers = " + ".join(f"CAST(coalesce({_is_outlier(c)}, false) AS INTEGER)" for c in WIND)
    return _with(
        READINGS,
        _night("night", "readings", _ALL),
        *_hampel("calm", "night", _ALL, extra=f", {outliers} AS outliers"),
        *_fill("clean", "calm", _ALL, MEASURES, "impute"),
        "counts AS (SELECT CAST(count(*) AS BIGINT) AS n_rows, "
        f"CAST(count(*) FILTER (WHERE {_elevation('date_time')} <= 0) AS BIGINT) AS night_rows, "
        f"CAST(sum(outliers) AS BIGINT) AS outliers, CAST(sum({nulls}) AS BIGINT) AS nulls_before, "
        f"(SELECT CAST(sum({nulls}) AS BIGINT) FROM clean) AS nulls_after FROM calm)",
        last="SELECT n_rows, night_rows, round(night_rows / greatest(n_rows, 1) * 100, 1) AS night_percent, "
        "outliers, round(outliers / greatest(n_rows * 2, 1) * 100, 3) AS outlier_percent, "
        "nulls_before, nulls_after, nulls_before - nulls_after AS nulls_resolved FROM counts",
    )


def _step_metrics() -> str:
    """Rows, nulls and changes before and after each step of two lists of steps."""
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in MEASURES)
    outliers = " + ".join(f"CAST(coalesce({_is_outlier(c)}, false) AS INTEGER)" for c in WIND)
    dark = f"{_elevation('date_time')} <= 0"

    def of(name: str) -> str:
        return f"(SELECT CAST(count(*) AS BIGINT) AS n, CAST(coalesce(sum({nulls}), 0) AS BIGINT) AS missing FROM {name})"

    def row(case: str, k: int, step: str, before: str, after: str, changed: str, percent: str) -> str:
        return (
            f"SELECT '{case}' AS \"case\", {k} AS position, '{step}' AS step, b.n AS rows_before, a.n AS rows_after, "
            f"b.missing AS nulls_before, a.missing AS nulls_after, CAST({changed} AS BIGINT) AS changed, "
            f"CAST({percent} AS DOUBLE) AS changed_percent, true AS wrote FROM {of(before)} b, {of(after)} a"
        )

    nights = f"(SELECT count(*) FILTER (WHERE {dark}) FROM readings)"
    share = f"round({nights} / greatest(b.n, 1) * 100, 1)"
    found = "(SELECT coalesce(sum(outliers), 0) FROM calm)"
    rows = [
        row("usual", 1, "zero_at_night", "readings", "night", nights, share),
        row("usual", 2, "hampel", "night", "calm", found, f"round({found} / greatest(b.n * 2, 1) * 100, 3)"),
        row("usual", 3, "impute", "calm", "clean", "b.missing - a.missing", "NULL"),
        row("other", 1, "zero_at_night", "readings", "night", nights, share),
        row("other", 2, "without_nights", "night", "day", "NULL", "NULL"),
        row("other", 3, "forward_fill", "day", "filled", "b.missing - a.missing", "NULL"),
    ]
    return _with(
        READINGS,
        _night("night", "readings", _ALL),
        *_hampel("calm", "night", _ALL, extra=f", {outliers} AS outliers"),
        *_fill("clean", "calm", _ALL, MEASURES, "impute"),
        f"day AS (SELECT * FROM night WHERE NOT ({dark}))",
        *_fill("filled", "day", _ALL, MEASURES, "ffill"),
        last=" UNION ALL ".join(rows),
    )


def oracle_sql() -> dict[str, str]:
    start, end = SOME_DAYS
    rolled = [*WIND, "nwp_globalirrad"]
    rolled_list = ", ".join(["station_id", "date_time", *rolled])
    final = _with(READINGS, _FINAL, last="SELECT * FROM final")
    clean = _with(READINGS, _FINAL, *_clean(_FINAL_COLUMNS, "final"), last="SELECT * FROM clean")
    many = ["station_id", "date_time", "power", "nwp_windspeed"]
    return {
        "avg_power": _avg(*WHOLE),
        "avg_power_bound": _avg(start, end),
        "avg_power_capped": _avg(start, end),
        "result_total": _from_readings("count(DISTINCT station_id) AS total_rows"),
        "range_filter": _with(READINGS, _FINAL, last=_between(", ".join(_ALL))),
        "range_from_days": _with(
            READINGS, _FINAL, last=_between(", ".join(FINAL_TYPES) + ", CAST(date_time AS DATE) AS day")
        ),
        "range_from_months": _with(
            READINGS,
            _FINAL,
            last=_between(", ".join(FINAL_TYPES) + ", CAST(date_trunc('month', date_time) AS DATE) AS month"),
        ),
        "station_counts": _from_readings("station_id, count(*) AS n_rows", "GROUP BY 1 ORDER BY 1"),
        "row_count_check": _from_readings(
            "count(*) AS n_rows, CAST(271968 AS BIGINT) AS expected, count(*) = 271968 AS ok"
        ),
        "sample_topk": _from_readings("*", "ORDER BY station_id, date_time LIMIT 5"),
        "scan_partitions": (
            "SELECT count(DISTINCT CAST(ts AS DATE)) AS partitions FROM events "
            f"WHERE CAST(ts AS DATE) BETWEEN DATE '{start[:10]}' AND DATE '{end[:10]}'"
        ),
        "scan_columns": (
            "SELECT count(DISTINCT CAST(ts AS DATE)) AS partitions, true AS adds_up, true AS less, true AS same_files FROM events "
            f"WHERE CAST(ts AS DATE) BETWEEN DATE '{start[:10]}' AND DATE '{end[:10]}'"
        ),
        "row_count_met": _from_readings(
            "count(*) AS n_rows, count(*) + extra AS expected, extra = 0 AS ok",
            "CROSS JOIN (VALUES (0), (1)) AS t(extra) GROUP BY extra",
        ),
        "fingerprint_changes": _with(
            READINGS,
            "n AS (SELECT count(*) AS n FROM events)",
            last="SELECT 'clustered and read again' AS \"case\", count(*) AS n_rows, true AS same FROM readings "
            "UNION ALL SELECT 'reordered', n, true FROM n UNION ALL SELECT 'null moved', n, false FROM n "
            "UNION ALL SELECT 'pair swapped', n + 2, false FROM n UNION ALL SELECT 'one value changed', n, false FROM n",
        ),
        "fingerprint_kept": _with(
            READINGS,
            f"n AS (SELECT count(*) AS n, count(*) FILTER (WHERE date_time < TIMESTAMP '{end}') AS early FROM readings)",
            last="SELECT 'loaded' AS \"case\", early AS n_rows, true AS same FROM n UNION ALL SELECT 'appended', n, true FROM n "
            "UNION ALL SELECT 'replaced', n, true FROM n UNION ALL SELECT 'compacted', n, true FROM n",
        ),
        "load_keep": _loaded(f"date_time >= TIMESTAMP '{end}' AND minute(date_time) = 0"),
        "load_replace": _loaded("minute(date_time) = 0"),
        "load_conflicts": _from_readings("count(*) AS n_rows, true AS refused", f"WHERE date_time < TIMESTAMP '{end}'"),
        "csv_seconds": "SELECT event_id, ts FROM events",
        "clean_custom_step": _with(
            READINGS,
            _night("night", "readings", _ALL),
            "later AS (SELECT * REPLACE (date_time + INTERVAL 127 HOUR AS date_time) FROM night)",
            *_hampel("calm", "later", _ALL),
            "other AS (SELECT * REPLACE (CAST(9 - station_id AS SMALLINT) AS station_id) FROM calm)",
            *_fill("clean", "other", _ALL, MEASURES, "impute"),
            last="SELECT * FROM clean",
        ),
        "clean_daily_pieces": clean,
        "fallback_stations": final,
        "cap_refused": _with(
            READINGS,
            _FINAL,
            f"kept AS ({_between('station_id')})",
            last="SELECT 0 AS spare, false AS refused, count(DISTINCT station_id) AS total_rows, true AS whole FROM kept "
            "UNION ALL SELECT -1, true, NULL, NULL",
        ),
        "refresh_report": _with(
            READINGS,
            "strong AS (SELECT * REPLACE (CASE WHEN station_id = 3 THEN date_time + INTERVAL 4 MINUTE "
            "ELSE date_time END AS date_time) FROM readings)",
            last=_QUALITY,
        ),
        "refresh_metrics": _step_metrics(),
        "arrivals_cleaned": _with(
            READINGS,
            _LONG,
            f"final AS (SELECT {', '.join(_ALL)}, {_delta_list()} FROM long)",
            *_clean(_FINAL_COLUMNS, "final"),
            last="SELECT * FROM clean",
        ),
        "fallback_source": "SELECT event_id, ts, user_id, event_type, value FROM events",
        "consolidate": final,
        "csv_roundtrip": final,
        "gold_roundtrip": final,
        "null_tokens": "SELECT event_id, CASE WHEN event_id % 5 = 4 THEN value END AS value FROM events",
        "parse_floor": (
            "SELECT event_id, ts AS parsed, time_bucket(INTERVAL 15 MINUTE, ts) AS floored FROM events"
        ),
        "deltas": _from_readings(f"station_id, date_time, {_delta_list()}"),
        "enforce_schema": final,
        "dup_keys": f"SELECT user_id, {_CELL} AS date_time, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1",
        "offgrid": _grid("ts", "events"),
        "offgrid_rows": (
            f"SELECT {_STATION} AS station_id, count(*) AS n_rows FROM events "
            "WHERE minute(ts) NOT IN (0, 15, 30, 45) GROUP BY 1"
        ),
        "irradiance_bounds": _with(READINGS, _STRONG, last=" UNION ALL ".join(_bounds(c) for c in IRRADIANCE)),
        "null_counts": _with(
            READINGS,
            "counts AS (" + " UNION ALL ".join(_nulls(c, "readings") for c in MEASURES) + ")",
            last='SELECT "column", violations AS nulls FROM counts WHERE violations > 0',
        ),
        "quality_report": _with(
            READINGS,
            _STRONG,
            last=_QUALITY,
        ),
        "gaps": _with(
            READINGS,
            f"steps AS (SELECT station_id, lag(date_time) OVER ({_ORDERED}) AS previous, date_time FROM readings)",
            last="SELECT station_id, previous, date_time, date_diff('minute', previous, date_time) AS gap_minutes "
            "FROM steps WHERE date_diff('minute', previous, date_time) > 15",
        ),
        "solar_elevation": (
            f"SELECT event_id, round({_elevation('ts')}, 9) AS elevation, {_elevation('ts')} <= 0 AS night FROM events"
        ),
        "night_zero": _with(READINGS, _night("night", "readings", _ALL), last="SELECT * FROM night"),
        "rolling_median": _from_readings(
            rolled_list + ", " + ", ".join(f"{_mid(c)} AS {c}_median" for c in rolled)
        ),
        "rolling_mad": _with(
            READINGS,
            *_deviations("w", "readings", rolled),
            last=f"SELECT {rolled_list}, " + ", ".join(f"mad_{c} AS {c}_mad" for c in rolled) + " FROM w_a",
        ),
        "hampel": _with(READINGS, *_hampel("calm", "readings", _ALL), last="SELECT * FROM calm"),
        "hampel_many_series": _with(
            SUPPLIERS, *_hampel("calm", "suppliers", many, ["power", "nwp_windspeed"]), last="SELECT * FROM calm"
        ),
        "hampel_wide": _with(
            READINGS, *_hampel("calm", "readings", ["station_id", "date_time", *WIND], half=500), last="SELECT * FROM calm"
        ),
        "ffill": _filled("ffill"),
        "bfill": _filled("bfill"),
        "interpolate": _filled("interpolate"),
        "impute": _filled("impute"),
        "impute_many_series": _with(
            SUPPLIERS,
            *_fill("filled", "suppliers", many, ["power", "nwp_windspeed"], "impute"),
            last="SELECT * FROM filled",
        ),
        "impute_irradiance": _by_sky(),
        "clean_series": clean,
        "clean_fresh_deltas": _with(
            READINGS,
            _FINAL,
            *_clean(_FINAL_COLUMNS, "final"),
            last=f"SELECT {', '.join(_ALL)}, {_delta_list()} FROM clean",
        ),
        "clean_metrics": _stage_metrics(),
        "refresh": clean,
        "arrivals": (
            "SELECT user_id AS station_id, ts AS date_time, "
            f"CASE WHEN {_elevation('ts')} <= 0 THEN 0.0::DOUBLE ELSE value END AS power FROM events"
        ),
        "load_id": (
            "SELECT o_orderkey, 'pvod_load_' || md5('gold/' || o_orderkey || '.parquet' || 'p' || 'd' || "
            "o_orderpriority || md5(o_orderstatus)) AS load_id FROM orders"
        ),
        "idempotent_append": final,
        "align_join": _join("INNER"),
        "align_join_left": _join("LEFT"),
        "align_join_full": _join("FULL"),
        "align_join_asof": _with(
            *(
                f"{name} AS (SELECT {_STATION} AS station_id, ts AS date_time, max(value) AS {value} FROM events "
                f"WHERE event_type = '{kind}' GROUP BY 1, 2)"
                for name, kind, value in (("f", "view", "forecast"), ("m", "click", "measured"))
            ),
            last="SELECT f.station_id, f.date_time, forecast, CASE WHEN near THEN m.date_time END AS measured_at, "
            "CASE WHEN near THEN measured END AS measured FROM f ASOF LEFT JOIN m "
            "ON f.station_id = m.station_id AND f.date_time >= m.date_time, "
            "LATERAL (SELECT f.date_time - m.date_time <= INTERVAL 30 MINUTE AS near)",
        ),
        "union_stations": (
            "SELECT 'supplier' AS kind, s_name AS name, s_acctbal AS balance FROM supplier "
            "UNION ALL SELECT 'customer', c_name, c_acctbal FROM customer"
        ),
    }
