"""Every registered query with an oracle matches DuckDB on the smallest
driver tables (the driver's own check runs at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck(sf_small):
    from oracle_check import duck as mk
    return mk(sf_small)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert "flagship_seasonal_climate" in SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, sf_small, name):
    from oracle_check import compare
    msg, ok = compare(name, spark, duck, sf_small, QUERIES[name], SQL[name])
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "season_num" in df.columns
