"""Every registered query equals its SQL, run by DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from ledgerspark.plans import catalog
from tests.oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["order_no", "order_no2", "amount", "time", "account"]


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(catalog.QUERIES[name](spark, SF_DIR), duck, catalog.ORACLE[name]) is None
