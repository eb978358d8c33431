"""Every registered query against its statement, on the smallest data."""

import pytest

import __spark_entry__ as entry
from check import compare
from conftest import DATA

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_statements_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        ok, note = compare(df, duck, SQL[name])
        assert ok, note
    else:
        assert df.count() >= 0
