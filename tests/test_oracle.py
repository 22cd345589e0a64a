"""Every registered query against its SQL on the smallest given tables."""

import pytest

import __spark_entry__ as entry_points
from checks.catalog import QUERIES
from checks.compare import differences, oracle_connection
from checks.oracle import SQL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SMALL)


def test_every_query_has_sql():
    """All of the library's own; the optional part also has some that SQL cannot express."""
    assert set(QUERIES) == set(SQL)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", entry_points.oracle_sql())
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, SMALL, name) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
