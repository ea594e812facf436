"""Plan guards: no pair-emitting joins and no Python on the row path in any
registered query; questions keep their scalable shapes."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from martwright.plans.registry import all_queries

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def _executed_plan(df) -> str:
    df.collect()  # same query execution: the final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_pair_joins_or_python_rows(spark, name):
    plan = _executed_plan(entry.queries()[name](spark, SF_SMALL))
    assert not [p for p in FORBIDDEN if p in plan], plan


def test_question_shapes(spark):
    qs = entry.queries()
    q4 = _executed_plan(qs["q04_geography_top10"](spark, SF_SMALL))
    assert "WindowGroupLimit" in q4 and "Expand" in q4  # top-k per level, grouping sets
    q2 = _executed_plan(qs["q02_top_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in q2
    q10 = qs["q10_asof_sales"](spark, SF_SMALL)
    plan = _executed_plan(q10)
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan  # fact filtered in place


def test_profiles_of_all_extracts_are_no_single_plan(spark):
    plan = _executed_plan(entry.queries()["extract_round_trip"](spark, SF_SMALL))
    assert "Aggregate" not in plan and plan.count("Scan parquet") >= 16  # stored, table by table
