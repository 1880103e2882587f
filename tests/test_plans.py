"""Scale guards on every registered query's physical plan (sf0.001)."""

import pytest

from lexiflow.plans.catalog import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
