"""Every registered query of the package on the smallest tables, against its SQL where it has one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tallyrate.llm import queries
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_all_are_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
