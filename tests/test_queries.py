"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) == ""


def test_entry_names_the_worst_blocks(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r["rank"] for r in rows} == set(range(1, max(r["rank"] for r in rows) + 1))
