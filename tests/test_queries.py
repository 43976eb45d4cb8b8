"""Every registered query against its SQL on the smallest given tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(spark, name, QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
