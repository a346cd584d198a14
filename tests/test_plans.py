"""Plan guards over every registered data query: no Python UDFs, no cross joins."""

import pytest

from gapwise.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_has_no_python_udf_or_cross_join(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad} in plan"


def test_narrow_session_query_prunes_columns(spark):
    df = catalog.QUERIES["total_sessions"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "value" not in plan  # only event_id, ts, user_id are read
