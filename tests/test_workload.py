"""Every registered query: same rows as its SQL, and a plan that scales."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tools.compare import compare, connect
from workload import QUERIES

SF = "/root/testdata/sf0.001"

# Only the projection has no SQL; its properties are checked by another query.
WITHOUT_SQL = {"pca_projection"}


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def no_all_pairs(df) -> None:
    plan = physical_plan(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan, plan


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    ok, note, _ = compare(spark, con, name, SF, inspect=no_all_pairs)
    assert ok, note


def test_contract(spark):
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    assert (set(queries) - set(oracles)) & set(QUERIES) == WITHOUT_SQL
    assert entry_module.entry(spark).count() == 200
    assert all(q.covers for q in QUERIES.values())
