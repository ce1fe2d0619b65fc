"""Late readings, cleaned again only where they reach, against one cleaning of everything."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sunsieve.operators.hampel import hampel
from sunsieve.operators.impute import impute
from sunsieve.operators.night import zero_at_night
from sunsieve.plans.clean import clean
from sunsieve.schema import DAY, MEASURES, STATION, TIME
from sunsieve.sources.tables import append_new, one_per_key
from sunsieve.streaming.arrivals import reclean
from sunsieve.streaming.reach import REACH, changed_units, day_summaries

FEW = ["nwp_windspeed", "lmd_temperature", "power"]
SCHEMA = f"station_id short, t string, {', '.join(f'{c} double' for c in MEASURES)}"


def made(seed):
    """Three stations over half a year: dense days, holes of months, nulls over weeks, rows without a time."""
    rng = random.Random(seed)
    rows = []
    for station in range(3):
        t, quiet = datetime(2023, 11, 1), 0
        for _ in range(120):
            t += timedelta(minutes=15 * rng.choice([1, 2, 30, 90, 96, 200, rng.choice([96, 6_000])]))
            quiet = max(0, quiet - 1) if quiet else (rng.randint(10, 40) if rng.random() < 0.06 else 0)
            values = {c: None if rng.random() < 0.3 else round(rng.uniform(0, 20), 2) for c in MEASURES}
            if quiet:
                values |= {"lmd_temperature": None, "power": None}
            if station == 2:
                values["nwp_pressure"] = None
            rows.append((station, str(t), *values.values()))
        if station:
            rows.append((station, None, *(float(station) for _ in MEASURES)))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select(STATION, F.col("t").cast("timestamp_ntz").alias(TIME), *MEASURES)


def same(found, want):
    found, want = found.select(want.columns), want.select(want.columns)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def arrive(spark, batches, folder, steps):
    raw, cleaned = str(folder / "raw"), str(folder / "cleaned")
    for rows in batches:
        batch = frame(spark, rows)
        append_new(one_per_key(batch), raw)
        reclean(raw, cleaned, batch.select(F.col(TIME).cast("date").alias(DAY)), steps)
    return raw, spark.read.parquet(cleaned).drop(DAY)


@pytest.mark.parametrize("seed", [2])
def test_arrivals_end_as_one_cleaning(spark, tmp_path, seed):
    rows = made(seed)
    rng = random.Random(seed)
    late = rng.sample(rows, 12)
    timeless = [r for r in rows if r[1] is None]
    first = [r for r in rows if r not in late and r not in timeless]
    batches = [first, late[:3], [*late[3:], *(r for r in timeless if r not in late)]]
    steps = (zero_at_night, hampel, impute)
    _, found = arrive(spark, batches, tmp_path, steps)
    same(found, clean(frame(spark, rows), steps))


def test_one_late_value_in_a_gap_of_months(spark, tmp_path):
    def row(day, hour, power):
        t = datetime(2023, 1, 1) + timedelta(days=day, hours=hour)
        return (1, str(t), *(power if c == "power" else 1.0 for c in MEASURES))

    first = [row(d, h, 100.0 if d in (0, 160) else None) for d in range(161) for h in (11, 12, 13)]
    late = [row(80, 14, 300.0)]
    raw, found = arrive(spark, [first, late], tmp_path, (impute,))
    same(found, clean(frame(spark, first + late), (impute,)))
    assert found.where("power IS NULL").isEmpty() and found.where("power > 100").count() > 400


def test_a_dense_table_is_rewritten_around_the_touched_day_only(spark):
    rows = []
    for station in (1, 2):
        for d in range(40):
            for h in range(24):
                t = datetime(2024, 1, 1) + timedelta(days=d, hours=h)
                rows.append((station, str(t), *(None if c == "power" and d in (9, 10, 12) and h > 3 else 1.0 for c in MEASURES)))
    df = frame(spark, rows).withColumn(DAY, F.col(TIME).cast("date"))
    touched = spark.createDataFrame([(date(2024, 1, 12),)], "day date")
    units = changed_units(day_summaries(df), touched).where("station_id = 1").collect()
    changed = {r.day.day for r in units if r.changed and r.day.month == 1}
    read = {r.day.day for r in units if r["read"] and r.day.month == 1}
    # The 12th arrived; the 11th and 13th lie within the filter's reach; nulls of the 10th end at a value of the 11th;
    # the 9th and 14th are whole. What is read are the days next to these.
    assert changed == {10, 11, 12, 13} and read >= changed and read <= set(range(8, 17))
    assert REACH == 4 and len(units) == 40


def test_steps_of_a_caller_and_the_first_call_clean_everything(spark, tmp_path):
    rows = made(5)[:60]

    def shifted(df):
        return df.withColumn("power", F.col("power") + 1)

    _, found = arrive(spark, [rows[:40], rows[40:]], tmp_path, (shifted, zero_at_night))
    same(found, clean(frame(spark, rows), (shifted, zero_at_night)))


def test_nothing_arrives(spark, tmp_path):
    rows = made(6)[:60]
    raw, found = arrive(spark, [rows], tmp_path, (zero_at_night,))
    before = found.collect()
    reclean(raw, str(tmp_path / "cleaned"), spark.createDataFrame([], "day date"), (zero_at_night,))
    after = spark.read.parquet(str(tmp_path / "cleaned")).drop(DAY).collect()
    assert sorted(map(str, before)) == sorted(map(str, after))
