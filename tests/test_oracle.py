"""Every query with SQL gives the rows that DuckDB gives on the same files."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from conftest import SF

pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    ok, note = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 1000
    assert "week_mean_price" in df.columns
