"""Every registered query against its reference SQL, on the smallest tables."""

import os

import pytest
from parity import compare, connect

import __spark_entry__ as contract
from newsmill.plans import catalog, oracles

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
SQL = oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_all_registered_queries_have_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL.get(name), SF_DIR) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns == contract.entry(spark).columns
