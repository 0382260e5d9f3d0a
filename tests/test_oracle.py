"""Every registered query against DuckDB on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from rowsieve_checks import batch, evolution, loads, oracle
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test data is not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [*batch.QUERIES, *loads.QUERIES, *evolution.QUERIES])
def test_query_equals_its_sql(spark, connection, name):
    assert name in entry.oracle_sql()
    difference = compare(spark, connection, name, SF_DIR)
    assert difference is None, difference


def test_every_sql_has_a_query():
    assert set(oracle.ORACLE) == {*batch.QUERIES, *loads.QUERIES, *evolution.QUERIES}
    assert set(oracle.ORACLE) <= set(entry.oracle_sql()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["office", "total_employees", "average_age"]
    assert frame.count() == 2
