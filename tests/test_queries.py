"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare
from beaconlake.reports import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, found = compare.spark_rows(entry.queries()[name](spark, SF_DIR))
    wanted_columns, wanted = compare.sql_rows(con, entry.oracle_sql()[name])
    assert columns == wanted_columns
    assert found == wanted


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["source", "purchases", "revenue"]
    assert not result.isEmpty()
