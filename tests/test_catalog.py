"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as driver
from tests.compare import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
QUERIES, SQL = driver.QUERIES, driver.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, QUERIES[name], SQL.get(name))
    assert ok, note


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and len(df.columns) == 20
