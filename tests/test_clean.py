import math

import pytest
from pyspark.sql import functions as F

import stations
from sunsieve.errors import BoundsError, TransformError
from sunsieve.functions.solar import solar_elevation
from sunsieve.operators import checks
from sunsieve.operators.hampel import hampel
from sunsieve.operators.impute import impute
from sunsieve.operators.night import zero_at_night
from sunsieve.plans.clean import clean, clean_measured, stage_metrics
from sunsieve.schema import DELTAS, MEASURES, NIGHT_ZERO, STATION, TIME, WIND
from sunsieve.sources.files import load_readings


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "dirty.csv"
    stations.write(path, stations.rows({**stations.NULLS, **stations.OUTLIER}))
    return load_readings(spark, str(path)).cache()


def elevation(day, hour, minute, latitude=38.0):
    tilt = math.radians(23.45) * math.sin(2 * math.pi / 365 * (284 + day))
    turn = math.radians(15) * (hour + minute / 60 - 12)
    at = math.radians(latitude)
    return math.asin(math.sin(at) * math.sin(tilt) + math.cos(at) * math.cos(tilt) * math.cos(turn))


def test_elevation(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp_ntz'2018-07-01 12:00:00', timestamp_ntz'2020-12-31 04:45:00')) AS date_time"
    )
    found = [r[0] for r in df.select(solar_elevation(F.col(TIME))).collect()]
    assert found == pytest.approx([elevation(182, 12, 0), elevation(366, 4, 45)], abs=1e-12)


def test_night_is_zero_and_day_is_kept(spark, dirty):
    after = zero_at_night(dirty)
    for hour, same in ((1, False), (12, True)):
        before, now = (d.where(F.hour(TIME) == hour).select(STATION, TIME, *NIGHT_ZERO) for d in (dirty, after))
        if same:
            assert now.exceptAll(before).isEmpty()
        else:
            assert now.where(" OR ".join(f"{c} <> 0" for c in NIGHT_ZERO)).isEmpty()
    assert after.columns == dirty.columns


def test_night_fills_nulls_and_spares_rows_without_time(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00' AS date_time, CAST(NULL AS DOUBLE) AS power UNION ALL SELECT NULL, 7D"
    )
    assert {(r[TIME] is None, r["power"]) for r in zero_at_night(df, ["power"]).collect()} == {(False, 0.0), (True, 7.0)}


def test_only_wind_is_filtered(dirty):
    after = hampel(dirty)
    rest = [c for c in dirty.columns if c not in WIND]
    assert after.select(rest).exceptAll(dirty.select(rest)).isEmpty()
    outlier = (F.col(STATION) == 8) & (F.col(TIME) == F.lit(str(stations.at(71))).cast("timestamp_ntz"))
    assert dirty.where(outlier).first()["lmd_windspeed"] == -345.5
    near = sorted([-345.5, *(float(stations.value("lmd_windspeed", 8, i)) for i in (69, 70, 72, 73))])
    assert after.where(outlier).first()["lmd_windspeed"] == near[2]


def test_nothing_is_null_after_imputing(dirty):
    assert checks.null_counts(dirty).collect()[0].asDict() == {"column": "lmd_pressure", "nulls": 5}
    assert checks.null_counts(impute(dirty)).isEmpty()


def test_cleaning_keeps_rows_columns_and_old_deltas(dirty):
    after = clean(dirty).cache()
    assert after.columns == dirty.columns and after.count() == dirty.count()
    keys = [STATION, TIME, *DELTAS]
    assert after.select(keys).exceptAll(dirty.select(keys)).isEmpty()
    fresh = clean(dirty, recompute_deltas=True)
    for name, (nwp, lmd) in DELTAS.items():
        assert fresh.where(F.col(name) != F.col(nwp) - F.col(lmd)).isEmpty()


def test_pieces_do_not_change_the_result(dirty):
    whole = clean(dirty, chunk_days=4000)
    assert clean(dirty, chunk_days=1).exceptAll(whole).isEmpty()


def test_steps_run_in_order_and_may_be_the_callers(dirty):
    seen = []

    def one(df):
        seen.append("one")
        return df.withColumn("power", F.lit(1.0))

    def two(df):
        seen.append("two")
        return df.withColumn("power", F.col("power") + 1)

    assert clean(dirty, [one, two]).agg(F.min("power"), F.max("power")).first() == (2.0, 2.0)
    assert seen == ["one", "two"]
    assert clean(dirty, []).exceptAll(dirty).isEmpty()


def test_steps_must_keep_the_columns(dirty):
    with pytest.raises(TransformError, match="changed the columns"):
        clean(dirty, [lambda df: df.drop("power")])


def test_errors_of_steps(dirty):
    def broken(df):
        raise RuntimeError("no")

    def domain(df):
        raise BoundsError("far out")

    with pytest.raises(TransformError, match="broken failed: no"):
        clean(dirty, [broken])
    with pytest.raises(BoundsError):
        clean(dirty, [domain])


def test_stage_metrics(dirty):
    found = stage_metrics(dirty).first().asDict()
    assert found["n_rows"] == stations.ROWS
    assert (found["nulls_before"], found["nulls_after"], found["nulls_resolved"]) == (5, 0, 5)
    assert found["outliers"] >= 1
    assert found["night_percent"] == round(found["night_rows"] / stations.ROWS * 100, 1)


def test_stage_metrics_of_nothing(dirty):
    found = stage_metrics(dirty.where("false")).first().asDict()
    assert found["n_rows"] == 0 and found["night_percent"] == 0.0 and found["outlier_percent"] == 0.0


def test_quality_report_counts_everything_at_once(dirty):
    report = {(r["check"], r["column"]): r for r in checks.quality_report(dirty).collect()}
    assert report["nulls", "lmd_pressure"]["violations"] == 5
    assert report["bounds", "nwp_globalirrad"]["violations"] == 0
    assert report["off_grid", TIME]["violations"] == 0
    assert len(report) == 4 + len(MEASURES) + 1


def test_row_count_contract(dirty):
    checks.require_rows(dirty, stations.ROWS)
    with pytest.raises(TransformError, match=f"expected 271968 rows, found {stations.ROWS}"):
        checks.require_rows(dirty)


def test_nan_is_out_of_bounds_but_not_missing(spark):
    df = spark.sql("SELECT double('NaN') AS nwp_globalirrad")
    assert checks.irradiance_bounds(df, ["nwp_globalirrad"]).first()["violations"] == 1
    assert checks.null_counts(df, ["nwp_globalirrad"]).isEmpty()


def test_callers_may_move_time_and_stations_between_pieces(spark, dirty):
    newest = F.lit(str(stations.at(0))).cast("timestamp_ntz")

    def backwards(df):
        assert not [c for c in df.columns if c.startswith("_")]
        return df.select(*[(newest - (F.col(TIME) - newest)).alias(TIME) if c == TIME else c for c in df.columns])

    found = clean(dirty, [zero_at_night, backwards, impute], chunk_days=1)
    assert found.exceptAll(impute(backwards(zero_at_night(dirty)))).isEmpty()


def test_metrics_are_those_of_the_steps_that_ran(dirty, tmp_path):
    landings = []

    def land(df):
        landings.append(f"{tmp_path}/{len(landings)}")
        df.write.parquet(landings[-1])
        return df.sparkSession.read.schema(df.schema).parquet(landings[-1])

    def halved(df):
        return df.where(F.col(STATION) < 5)

    steps = (zero_at_night, hampel, impute)
    rows, metrics = clean_measured(dirty, land, steps)
    assert rows.columns == dirty.columns and rows.exceptAll(clean(dirty, steps)).isEmpty() and rows.count() == stations.ROWS
    assert len(landings) == 1  # one plan, written once
    found, old = [r.asDict() for r in metrics.orderBy("position").collect()], stage_metrics(dirty).first()
    assert [(r["step"], r["rows_before"], r["rows_after"]) for r in found] == [(s.__name__, stations.ROWS, stations.ROWS) for s in steps]
    assert [r["changed"] for r in found] == [old.night_rows, old.outliers, old.nulls_resolved]
    assert [r["changed_percent"] for r in found] == [old.night_percent, old.outlier_percent, None]
    assert (found[1]["nulls_after"], found[2]["nulls_after"]) == (5, 0)

    only = clean_measured(dirty, land, (zero_at_night,))[1].collect()
    assert [(r.step, r.nulls_after) for r in only] == [("zero_at_night", 5)]
    rows, metrics = clean_measured(dirty, land, (impute, halved, hampel))
    assert rows.exceptAll(clean(dirty, (impute, halved, hampel))).isEmpty()
    told = {r.step: r for r in metrics.collect()}
    assert (told["halved"].rows_before, told["halved"].rows_after, told["halved"].changed) == (stations.ROWS, stations.ROWS // 2, None)
    assert told["hampel"].rows_before == stations.ROWS // 2 and told["impute"].changed == 5
    rows, metrics = clean_measured(dirty, land, ())
    assert metrics.isEmpty() and rows.count() == stations.ROWS
    with pytest.raises(TransformError, match="changed the columns"):
        clean_measured(dirty, land, [lambda df: df.drop("power")])
