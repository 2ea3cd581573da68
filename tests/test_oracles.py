"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as driver
from compare import connect, difference
from kerbside.harness import oracles, registry

SF_DIR = os.environ.get("KERBSIDE_TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and max(r["rank"] for r in rows) == 5
