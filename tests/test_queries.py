"""Every registered query against its SQL text, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from checks.oracles import all_sql
from presswork.plans.registry import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = {n: entry.queries()[n] for n in all_queries()}, all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_sql_text():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    _, rows, problem = compare(spark, con, name, QUERIES[name], SQL[name], FOLDER)
    assert not problem, problem
    assert rows >= 0


def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["day", "name", "value", "unit", "dimensions"]
    assert not frame.isEmpty()
