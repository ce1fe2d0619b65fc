"""What the physical plans must look like to hold at a thousand times the data."""

import re

import pytest

from sunsieve import catalog
from sunsieve.operators.align import with_deltas
from sunsieve.operators.hampel import hampel
from sunsieve.operators.impute import impute
from sunsieve.plans.clean import clean
from sunsieve.plans.metrics import average_power
from sunsieve.schema import FINAL_TYPES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "rows")
    with_deltas(catalog.readings(spark, SF)).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("Initial Plan")[0]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def windows(plan: str) -> list[str]:
    return [line for line in plan.split("\n") if re.search(r"\bWindow \[", line)]


def test_rows_are_shuffled_once_and_the_shuffle_is_shared(stored, no_broadcast):
    plan = final_plan(clean(stored))
    assert set(FINAL_TYPES) == set(stored.columns)
    assert "ReusedExchange" in plan
    # Scans: the rows, and twice the wind columns alone for the rows near a piece's edge.
    narrow = "ReadSchema: struct<station_id:smallint,date_time:timestamp_ntz,nwp_windspeed:double,lmd_windspeed:double>"
    assert plan.count("ReadSchema: struct<") == 3 and plan.count(narrow) == 2
    # By piece: the rows, the two edge tables, what lies outside. Nothing more for the join.
    by_piece = re.findall(r"\bExchange hashpartitioning\(_series#\d+, _chunk#\d+, ", plan)
    assert len(by_piece) == 4 + plan.count("ReusedExchange")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_window_holds_a_whole_station_of_rows(stored):
    for step in (hampel, impute, clean):
        for line in windows(final_plan(step(stored))):
            spec = line[line.rindex("], [_series"):]
            if "_chunk" not in spec.split("]")[1]:
                # Per station only tables with one row per piece are scanned.
                assert re.search(r"_tail|_head|_rows|_w\d+", line), line


def test_edges_are_cut_down_before_the_shuffle(stored):
    plan = final_plan(hampel(stored))
    assert len(re.findall(r"WindowGroupLimit .*Partial", plan)) == 2


def test_fills_sort_twice_and_shuffle_once(stored, no_broadcast):
    plan = final_plan(impute(stored))
    assert "ReusedExchange" in plan
    assert len(re.findall(r"ReadSchema: struct", plan)) == 1


def test_averages_combine_before_the_shuffle_and_read_few_columns(stored):
    plan = final_plan(average_power(stored, *catalog.SOME_DAYS))
    assert "partial_avg(power" in plan
    assert "ReadSchema: struct<station_id:smallint,date_time:timestamp_ntz,power:double>" in plan
    assert "GreaterThanOrEqual(date_time" in plan


def test_no_python_in_any_plan(spark):
    for name in ("clean_series", "quality_report", "dup_keys", "solar_elevation", "align_join"):
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name
