"""Every registered query against its SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from marketlake.plans import oracles
from marketlake.plans import queries as registered
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(oracles.oracle_sql()) == set(registered.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert compare(got, con.sql(SQL[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
