"""Every query with SQL equals it; every other query returns rows."""

from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as entry_points

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"predictions"}))
def test_returns_rows(spark, folder, name):
    assert not QUERIES[name](spark, folder).isEmpty()


def test_entry_returns_all_levels(spark, folder):
    assert entry_points.entry(spark).select("level").distinct().count() == 6


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
