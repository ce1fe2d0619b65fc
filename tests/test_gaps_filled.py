"""Irradiance by the clear sky and splines, against plain Python on ragged series, cut in many ways."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunsieve import catalog
from sunsieve.operators.clearsky import impute_irradiance
from sunsieve.operators.impute import impute
from sunsieve.operators.spline import edge_curves, filled, impute_spline, summary
from sunsieve.plans.clean import clean
from sunsieve.schema import STATION, TIME
from test_clean import elevation
from test_series import CUTS, back, expected, frame, ragged


def natural_spline(values):
    """One dense system over the whole series."""
    known = [(float(i), v) for i, v in enumerate(values) if v is not None]
    if not known:
        return values
    x, y = (np.array(c) for c in zip(*known))
    n = len(x)
    a, b = np.eye(n), np.zeros(n)
    for i in range(1, n - 1):
        h, g = x[i] - x[i - 1], x[i + 1] - x[i]
        a[i, i - 1 : i + 2] = h, 2 * (h + g), g
        b[i] = 6 * ((y[i + 1] - y[i]) / g - (y[i] - y[i - 1]) / h)
    m = np.linalg.solve(a, b)

    def at(i):
        if i <= x[0] or i >= x[-1]:
            return y[0] if i <= x[0] else y[-1]
        k = int(np.searchsorted(x, i))
        h = x[k] - x[k - 1]
        p, q = (x[k] - i) / h, (i - x[k - 1]) / h
        return p * y[k - 1] + q * y[k] + ((p**3 - p) * m[k - 1] + (q**3 - q) * m[k]) * h * h / 6

    return [v if v is not None else float(at(i)) for i, v in enumerate(values)]


def close(found, want):
    assert set(found) == set(want)
    for key, values in want.items():
        got, wanted = ([math.nan if v is None else v for v in x] for x in (found[key], values))
        assert got == pytest.approx(wanted, rel=1e-9, abs=1e-9, nan_ok=True), key


@pytest.mark.parametrize("chunk_days", [*CUTS, 32])
@pytest.mark.parametrize("seed", [1, 2])
def test_splines_do_not_depend_on_the_cut(spark, seed, chunk_days):
    made = ragged(seed)
    found = back(impute_spline(frame(spark, made), ["x", "y"], chunk_days=chunk_days))
    close(found, expected(made, natural_spline))


@pytest.mark.parametrize("seed", range(40))
def test_pieces_of_any_size_give_one_spline(seed):
    rng = random.Random(seed)
    values = [rng.uniform(-5, 9) if rng.random() < rng.choice([0.1, 0.5, 0.9]) else None for _ in range(rng.randint(1, 60))]
    cuts = sorted({0, len(values), *(rng.randint(0, len(values)) for _ in range(rng.randint(0, 9)))})
    pieces = [np.array([np.nan if v is None else v for v in values[a:b]]) for a, b in zip(cuts, cuts[1:])]
    told = edge_curves(np.array([summary(p) for p in pieces]))
    found = np.concatenate([filled(p, t) for p, t in zip(pieces, told)])
    want = np.array([np.nan if v is None else v for v in natural_spline(values)])
    np.testing.assert_allclose(found, want, rtol=1e-9, atol=1e-9)


def test_spline_keeps_what_is_known_and_other_columns(spark):
    made = ragged(3)
    df = frame(spark, made).withColumn("_mark", F.monotonically_increasing_id()).withColumn("x", F.when(F.col("y") > 8, float("nan")).otherwise(F.col("x")))
    df = df.cache()
    found = impute_spline(df, ["x", "missing"])
    assert found.columns == df.columns and dict(found.dtypes) == dict(df.dtypes)
    was = {(r[STATION], r[TIME]): (r.x, r.y, r["_mark"]) for r in df.collect()}
    for r in found.collect():
        x, y, mark = was[r[STATION], r[TIME]]
        assert (r.y, r["_mark"]) == (y, mark)
        assert x is None or r.x == x or (math.isnan(x) and math.isnan(r.x))
    assert impute_spline(df.limit(0), ["x"]).isEmpty()
    assert impute_spline(df, ["missing"]) is df or impute_spline(df, ["missing"]).columns == df.columns


def test_spline_as_a_step_of_cleaning(spark):
    made = ragged(4)
    df = frame(spark, made)
    step = lambda rows: impute_spline(rows, ["x", "y"])
    close(back(clean(df, [step])), expected(made, natural_spline))


def sky(t):
    height = math.sin(elevation(t.timetuple().tm_yday, t.hour, t.minute))
    return 1098.0 * height * math.exp(-0.059 / height) if height > 0 else 0.0


def by_sky(series):
    """Lines of the index over rows of daylight, ends carried on; nulls at night are 0."""
    out = {t: v for t, v in series}
    lit = [(t, v) for t, v in sorted(x for x in series if x[0]) if sky(t) >= 1]
    known = [(i, v / sky(t)) for i, (t, v) in enumerate(lit) if v is not None]
    for i, (t, v) in enumerate(lit):
        if v is None and known:
            before, after = [k for k in known if k[0] < i], [k for k in known if k[0] > i]
            if before and after:
                (a, p), (b, q) = before[-1], after[0]
                index = p + (i - a) * (q - p) / (b - a)
            else:
                index = before[-1][1] if before else after[0][1]
            out[t] = min(index * sky(t), 1361.0)
    for t, v in series:
        if v is None and t and sky(t) < 1:
            out[t] = 0.0
    return out


@pytest.mark.parametrize("chunk_days", [1, 32])
def test_irradiance_follows_the_clear_sky(spark, chunk_days):
    rng = random.Random(7)
    rows, want = [], {}
    for station in range(4):
        series = []
        for i in range(96 * 3):
            t = datetime(2024, 3, 1) + timedelta(minutes=15 * i * (1 + 40 * (station == 2)))
            value = round(sky(t) * rng.uniform(0.2, 1.3), 3) if station != 3 and rng.random() < 0.6 else None
            series.append((t, value))
        series.append((None, None if station else 5.0))
        want |= {(station, t): v for t, v in by_sky(series).items()}
        rows += [(station, str(t) if t else None, v) for t, v in series]
    df = spark.createDataFrame(rows, "station_id short, t string, lmd_totalirrad double")
    df = df.select(STATION, F.col("t").cast("timestamp_ntz").alias(TIME), "lmd_totalirrad").repartition(3)
    found = {(r[STATION], r[TIME]): r["lmd_totalirrad"] for r in impute_irradiance(df, chunk_days=chunk_days).collect()}
    close({k: [v] for k, v in found.items()}, {k: [v] for k, v in want.items()})
    # Measured values stay to the bit, nights are dark, and a station without values by day keeps its gaps.
    assert all(found[s, t and datetime.fromisoformat(t)] == v for s, t, v in rows if v is not None)
    assert all(v == 0.0 for (s, t), v in found.items() if s == 3 and t and sky(t) < 1)
    assert all(v is None for (s, t), v in found.items() if s == 3 and t and sky(t) >= 1)


def test_a_sky_fill_is_closer_than_a_line(spark):
    rows = []
    for i in range(96):
        t = datetime(2024, 6, 1) + timedelta(minutes=15 * i)
        rows.append((1, str(t), sky(t) * 0.8 if i in (26, 76) or not 26 < i < 76 else None))
    df = spark.createDataFrame(rows, "station_id short, t string, nwp_globalirrad double")
    df = df.select(STATION, F.col("t").cast("timestamp_ntz").alias(TIME), "nwp_globalirrad")
    noon = F.col(TIME) == F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")
    near = 0.8 * sky(datetime(2024, 6, 1, 12))
    assert impute_irradiance(df).where(noon).first()[2] == pytest.approx(near, rel=1e-9)
    assert impute(df, ["nwp_globalirrad"]).where(noon).first()[2] < 0.5 * near


def test_spline_query_equals_a_plain_solver(spark):
    sf = "/root/testdata/sf0.001"
    columns = ["power", *catalog.IRRADIANCE]
    series = {}
    for r in catalog.readings(spark, sf).orderBy(STATION, TIME).collect():
        series.setdefault(r[STATION], []).append(r)
    found = {(r[STATION], r[TIME]): r for r in catalog.queries()["impute_spline"](spark, sf).collect()}
    for station, rows in series.items():
        for c in columns:
            for r, value in zip(rows, natural_spline([r[c] for r in rows])):
                assert found[station, r[TIME]][c] == pytest.approx(value, rel=1e-8, abs=1e-8)
    assert len(found) == sum(map(len, series.values()))
