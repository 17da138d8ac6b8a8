"""Every registered query against its SQL, on whole tables."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as driver
from labtables.queries import ORACLES
from labtables.queries import QUERIES as PACKAGE_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = PACKAGE_QUERIES, ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["l_suppkey", "x", "y"] and df.count() > 0
