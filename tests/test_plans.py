"""Plan-shape guards: what must never appear, and where map-side
combining must happen."""

import re

import pytest

from stockline.registry import QUERIES

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_forbidden_operators(spark, sf001, name):
    plan = physical(QUERIES[name](spark, sf001))
    assert [op for op in FORBIDDEN if op in plan] == []


def test_erp_stock_combines_before_shuffle(spark, sf001):
    from stockline.plans.stock import erp_stock
    plan = physical(erp_stock(spark, sf001))
    assert "partial_sum" in plan


def test_first_per_key_combines_before_shuffle(spark):
    from stockline.operators import first_per_key
    df = spark.createDataFrame([("k", i, "x") for i in range(10)], "k string, o int, v string")
    plan = physical(first_per_key(df, ["k"], ["o"]))
    assert "partial_min" in plan and "Window" not in plan


def test_first_per_key_deals_rows_before_it_sorts(spark):
    from stockline.operators import first_per_key
    df = spark.createDataFrame([("k", i, "x") for i in range(10)], "k string, o int, v string")
    plan = physical(first_per_key(df, ["k"], ["o"]))
    partial, dealt = plan.index("partial_min"), plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert partial < dealt and "ENSURE_REQUIREMENTS" in plan[:partial]


def test_stock_delta_single_join_and_pushdown(spark, sf001):
    df = QUERIES["stock_delta"](spark, sf001)
    plan = physical(df)
    assert "Window" not in plan
    assert re.search(r"PushedFilters: \[[^\]]+\]", plan)
