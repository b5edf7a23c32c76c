"""Plan-shape rules over every registered query (checked on the smallest tables)."""

import re

import pytest

from quarry.plans.catalog import QUERIES

from conftest import SMALL

# Only these may plan a nested-loop join: their other side is the 9-row
# literal failure-signature table matched with ``contains``.
NESTED_LOOP_OK = {"j9_signature_hits", "c12_health_report"}
# Only the tokenizer hook runs Python inside a query plan.
PYTHON_OK = {"p1_tokenizer_hook"}


def _plan(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    if name not in NESTED_LOOP_OK:
        assert "BroadcastNestedLoopJoin" not in plan, name
    if name not in PYTHON_OK:
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan), name
