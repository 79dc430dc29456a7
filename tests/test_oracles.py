"""Every query with SQL gives the same rows in Spark and in DuckDB, over whole tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences


@pytest.fixture(scope="module")
def con(sf_check):
    return connect(sf_check)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, sf_check, name):
    df = entry.queries()[name](spark, sf_check)
    assert differences(df, con, entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 10
