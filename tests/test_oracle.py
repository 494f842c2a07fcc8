"""Every query with check SQL against DuckDB on the smallest scale factor."""

import os

import pytest

import __spark_entry__ as entry
from assay.queries.base import CHECK_SQL
from tests.oracle import compare, duck_connection

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_matches_duckdb(spark, con, name):
    why = compare(con, entry.queries()[name](spark, FOLDER), entry.oracle_sql()[name])
    assert why is None


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
