"""Plan properties of the llm queries on the smallest tables."""

import pytest

from salesmart.llm.queries import QUERIES

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInArrow", "FlatMapGroupsInPandas")
NATIVE = ("op2_surrogates", "op5_quality_rules")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_where_functions_are_asked_for(spark, name):
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert name not in NATIVE or not any(node in text for node in PYTHON)
