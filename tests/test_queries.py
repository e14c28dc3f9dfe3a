"""Every registered query against its SQL, and the coverage of the register itself."""

import pytest

import __spark_entry__ as entry_point
from cellframe import CELL_SCHEMA
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# The package of training data operators has its own tests, and may be absent.
QUERIES, SQL = entry_point.catalog.QUERIES, entry_point.catalog.SQL


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    assert compare(con, result, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.schema == CELL_SCHEMA
    assert df.limit(1).count() == 1
