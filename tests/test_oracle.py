"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import compare, database

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql:
        assert compare(df, con, sql) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
