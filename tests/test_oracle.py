"""Every catalog query against its DuckDB oracle (sf0.001), as the driver does at sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SQL = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, small_dir, name):
    got = QUERIES[name](spark, small_dir).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    assert compare(name, got, want) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).count() >= 1


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.schema == entry.entry(spark).schema
