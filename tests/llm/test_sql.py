"""Queries that SQL can express, against it; and that all operators and the pipeline are registered."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare
from conftest import SF_DIR
from pitlane.llm import queries


@pytest.mark.parametrize("name", queries.SQL)
def test_matches_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF_DIR), compare.connect(SF_DIR), queries.SQL[name]) == []


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op2_line_quality", "op4_slot_sharding"])
def test_native(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "Scan ExistingRDD", "CartesianProduct"))
