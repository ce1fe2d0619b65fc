"""Every registered query against its SQL twin on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from sunsieve import catalog, oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(table) -> list[str]:
    frame = table.to_pandas()
    return sorted(map(str, frame[sorted(frame.columns)].itertuples(index=False, name=None)))


def test_names_match():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(QUERIES) - set(SQL) == {"scan_estimate", "fingerprint", "impute_spline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, other, name):
    mine, theirs = QUERIES[name](spark, SF).toArrow(), other.sql(SQL[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in mine.schema} == {f.name: str(f.type) for f in theirs.schema}
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", ["scan_estimate", "fingerprint"])
def test_runs_and_repeats(spark, name):
    once = QUERIES[name](spark, SF).collect()
    assert len(once) == 1
    if name == "fingerprint":
        assert QUERIES[name](spark, SF).collect() == once


def test_entry(spark):
    assert contract.entry(spark).count() == 10
