"""Every query against its SQL, or against its row count where there is none."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"

# The optional queries have their own tests.
CORE = sorted(set(entry.queries()) - set(entry._optional()[0]))
CORE_SQL = sorted(set(entry.oracle_sql()) & set(CORE))


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", CORE_SQL)
def test_query_equals_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(CORE) - set(CORE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "zone", "dist_bin", "margin_cat", "period", "shots", "total", "fg"]

