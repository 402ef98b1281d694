"""Every query that has SQL gives the same rows as DuckDB; every other one runs."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from foliospark import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, data, name):
    found = compare(spark, con, data, QUERIES[name], SQL[name])
    assert found in ("", "no rows"), found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, data):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and set(e.oracle_sql()) <= set(e.queries())
