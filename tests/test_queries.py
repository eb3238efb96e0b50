"""Every registered query against its SQL, and its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare
from conftest import SF_DIR
from pitlane.plans import oracle, registry

QUERIES = {name: run for name, run in entry.queries().items() if name in registry.QUERIES}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in oracle.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.differences(df, duck, ORACLE[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
