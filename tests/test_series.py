"""Windowed steps against plain Python on ragged series, cut in many ways."""

import random
from datetime import datetime, timedelta
from statistics import median
from time import perf_counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunsieve.operators.checks import _steps, gaps
from sunsieve.operators.hampel import hampel, rolling_mad, rolling_median
from sunsieve.operators.impute import backward_fill, forward_fill, impute, interpolate
from sunsieve.operators.series import KEYS, cut
from sunsieve.operators.wide import WIDE, sliding_median
from sunsieve.schema import STATION, TIME

CUTS = [1, 3, 400]


def ragged(seed: int) -> dict[int, list]:
    """Per station (time, x, y) in time order, with holes up to weeks and null runs."""
    rng = random.Random(seed)
    made = {}
    for station in range(5):
        time, rows = datetime(2023, 12, 20), []
        for _ in range(rng.choice([1, 2, 9, 60])):
            time += timedelta(minutes=15 * rng.choice([1, 1, 1, 2, 40, 2000]))
            x = None if rng.random() < 0.5 else float(rng.randint(0, 30))
            rows.append((time, x, None if station == 3 else round(rng.random() * 9, 2)))
        made[station] = rows
    made[5] = [(None, 5.0, 1.0), *((datetime(2024, 1, 1 + i), None, float(i)) for i in range(4))]
    made[None] = [(datetime(2024, 1, 1 + i), [None, 2.0, None, 8.0][i], 1.0) for i in range(4)]
    return made


def frame(spark, made):
    rows = [(s, str(t) if t else None, x, y) for s, series in made.items() for t, x, y in series]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "station_id short, t string, x double, y double")
    return df.select(STATION, F.col("t").cast("timestamp_ntz").alias(TIME), "x", "y").repartition(3)


def back(df, columns=("x", "y")) -> dict:
    return {(r[STATION], r[TIME]): tuple(r[c] for c in columns) for r in df.collect()}


def expected(made, step) -> dict:
    out = {}
    for s, series in made.items():
        xs, ys = step([x for _, x, _ in series]), step([y for _, _, y in series])
        out |= {(s, t): (x, y) for (t, _, _), x, y in zip(series, xs, ys)}
    return out


def rolled(values, window):
    half = window // 2
    near = [[v for v in values[max(0, i - half): i + half + 1] if v is not None] for i in range(len(values))]
    return [median(n) if n else None for n in near]


def deviations(values, window):
    return [None if v is None else abs(v - m) for v, m in zip(values, rolled(values, window))]


def mads(values, window):
    return [max(m, 1e-10) if m is not None else 1e-10 for m in rolled(deviations(values, window), window)]


def filtered(values, window, threshold=3.0):
    parts = zip(values, rolled(values, window), deviations(values, window), mads(values, window))
    return [m if d is not None and d > threshold * 1.4826 * a else v for v, m, d, a in parts]


def ffilled(values):
    out, last = [], None
    for v in values:
        last = v if v is not None else last
        out.append(last)
    return out


def bfilled(values):
    return ffilled(values[::-1])[::-1]


def lined(values):
    out = list(values)
    known = [i for i, v in enumerate(values) if v is not None]
    for a, b in zip(known, known[1:]):
        slope = (values[b] - values[a]) / (b - a)
        for i in range(a + 1, b):
            out[i] = values[a] + (i - a) * slope
    return out


def imputed(values):
    return bfilled(ffilled(lined(values)))


@pytest.mark.parametrize("days", CUTS)
@pytest.mark.parametrize("seed", [1, 2])
def test_fills_match_plain_python(spark, days, seed):
    made = ragged(seed)
    df = frame(spark, made)
    for step, plain in (
        (forward_fill, ffilled),
        (backward_fill, bfilled),
        (interpolate, lined),
        (impute, imputed),
    ):
        assert back(step(df, ["x", "y"], chunk_days=days)) == expected(made, plain), step.__name__


@pytest.mark.parametrize("days", CUTS)
@pytest.mark.parametrize("window", [1, 3, 5, 9])
def test_hampel_matches_plain_python(spark, days, window):
    made = ragged(3)
    df = frame(spark, made)
    found = back(hampel(df, ["x", "y"], window=window, chunk_days=days))
    assert found == expected(made, lambda v: filtered(v, window))


@pytest.mark.parametrize("days", CUTS)
def test_rolling_values_match_plain_python(spark, days):
    made = ragged(4)
    df = frame(spark, made)
    medians = back(rolling_median(df, ["x", "y"], chunk_days=days), ["x_median", "y_median"])
    assert medians == expected(made, lambda v: rolled(v, 5))
    found = back(rolling_mad(df, ["x", "y"], chunk_days=days), ["x_mad", "y_mad"])
    assert found == expected(made, lambda v: mads(v, 5))


@pytest.mark.parametrize("days", CUTS)
def test_gaps_match_plain_python(spark, days):
    made = ragged(5)
    steps = {(r[STATION], r[TIME]): r["previous"] for r in _steps(frame(spark, made).select(STATION, TIME), chunk_days=days).collect()}
    assert steps == {(s, t): p for s, series in made.items() for (t, _, _), p in zip(series, [None, *(q for q, _, _ in series)])}
    wide = {(s, b[0]) for s, series in made.items() for a, b in zip(series, series[1:]) if a[0] and (b[0] - a[0]) > timedelta(minutes=15)}
    assert {(r[STATION], r[TIME]) for r in gaps(frame(spark, made)).collect()} == wide


def test_gaps_do_not_depend_on_the_zone(spark):
    df = spark.sql("SELECT 1S AS station_id, explode(array(timestamp_ntz'2024-03-10 01:45:00', timestamp_ntz'2024-03-10 03:00:00')) AS date_time")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert gaps(df).first()["gap_minutes"] == 75
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rows_decide_the_line_not_the_time_between(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 15), datetime(2024, 1, 9)]
    made = {1: [(t, x, None) for t, x in zip(times, [0.0, None, 10.0])]}
    assert back(impute(frame(spark, made), ["x"]))[1, times[1]][0] == 5.0


def test_stations_do_not_mix(spark):
    start = datetime(2024, 1, 1)
    made = {s: [(start + timedelta(minutes=15 * i), 100.0 * s, None) for i in range(6)] for s in (1, 2)}
    assert back(hampel(frame(spark, made), ["x"])) == {(s, t): (x, None) for s, v in made.items() for t, x, _ in v}


def test_an_outlier_becomes_the_median_and_is_flagged(spark):
    values = [3.3, 3.3, 3.3, 999.9, 3.3, 3.3, 3.3]
    made = {1: [(datetime(2024, 1, 1, i), v, None) for i, v in enumerate(values)]}
    rows = hampel(frame(spark, made), ["x"], flag_prefix="out_").orderBy(TIME).collect()
    assert [r["x"] for r in rows] == [3.3] * 7
    assert [r["out_x"] for r in rows] == [False] * 3 + [True] + [False] * 3


def test_null_in_the_centre_stays(spark):
    made = {1: [(datetime(2024, 1, 1, i), v, None) for i, v in enumerate([1.0, 2.0, None, 3.0, 4.0])]}
    assert back(hampel(frame(spark, made), ["x"]))[1, datetime(2024, 1, 1, 2)][0] is None


@pytest.mark.parametrize("window", [0, 2, 4])
def test_windows_must_be_odd(spark, window):
    with pytest.raises(ValueError):
        hampel(frame(spark, ragged(1)), ["x"], window=window)


def test_pieces_of_a_hot_station_stay_small(spark):
    """One station with most of the rows is cut as finely as the others."""
    step = "timestamp_ntz'1999-06-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT) * 15)"
    hot = spark.range(40_000).select(F.lit(7).cast("short").alias(STATION), F.expr(step).alias(TIME))
    cold = spark.range(500).select(F.lit(8).cast("short").alias(STATION), F.expr(step).alias(TIME))
    sizes = cut(hot.union(cold), 8).groupBy(*KEYS).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] == 8 * 96 and sizes[1] > 40_000 / (8 * 96)


def test_columns_and_order_are_kept(spark):
    df = frame(spark, ragged(1)).withColumn("note", F.lit("n"))
    assert hampel(df, ["x"]).columns == df.columns
    assert impute(df, ["x", "absent"]).columns == df.columns
    assert impute(df, ["absent"]).columns == df.columns


@pytest.mark.parametrize("chunk_days", [1, 400])
@pytest.mark.parametrize("window", [WIDE, 1_001])
def test_wide_windows_slide(spark, window, chunk_days):
    made = ragged(11)
    rng = random.Random(2)
    time, rows = datetime(2024, 1, 1), []
    for i in range(260):
        time += timedelta(minutes=15 * rng.choice([1, 1, 30, 200]))
        rows.append((time, None if rng.random() < 0.2 else float(rng.randint(0, 30)), 400.0 if i == 120 else round(rng.random(), 2)))
    made[7] = rows
    df = frame(spark, made)
    for step, plain, suffix in ((rolling_median, rolled, "_median"), (rolling_mad, mads, "_mad")):
        found = step(df, ["x", "y"], window, chunk_days=chunk_days)
        assert found.columns == [*df.columns, f"x{suffix}", f"y{suffix}"]
        assert back(found, (f"x{suffix}", f"y{suffix}")) == expected(made, lambda v: plain(v, window))
    found = hampel(df, ["x", "y"], window, flag_prefix="_f_", chunk_days=chunk_days)
    assert back(found) == expected(made, lambda v: filtered(v, window))
    assert found.where("_f_y").count() >= 1 and found.columns == [*df.columns, "_f_x", "_f_y"]


def test_sliding_medians_cost_little_more_in_wider_windows():
    values = np.random.default_rng(1).normal(size=20_000)
    seconds = {}
    for half in (50, 500, 5_000):
        start = perf_counter()
        found = sliding_median(values, half)
        seconds[half] = perf_counter() - start
        for at in (0, 7, 9_999, 19_999):
            assert found[at] == np.median(values[max(0, at - half) : at + half + 1])
    assert seconds[5_000] < 20 * seconds[50] + 0.5
    odd = sliding_median(np.array([np.nan, 1.0, np.inf, np.nan, 3.0]), 1)
    assert odd.tolist()[:2] == [1.0, np.inf] and odd.tolist()[4] == 3.0
