"""Plan-shape guards: the physical properties the design relies on."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_no_python_udf_in_any_query(spark):
    for name, fn in E.core_queries().items():
        plan = _plan(fn(spark, SF001))
        assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", plan), name


def test_validity_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["fct_orders"](spark, SF001))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("IsNotNull(l_orderkey)" in p for p in pushed)
    assert any("IsNotNull(o_orderkey)" in p for p in pushed)


def test_fact_join_shuffles_orders_once_at_scale(spark, no_broadcast):
    plan = _plan(E.queries()["fct_orders"](spark, SF001))
    assert plan.count("SortMergeJoin") == 1
    # lineitem: dedupe exchange + join exchange; orders: one exchange shared by dedupe and join
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3


def test_daily_revenue_order_level_aggregate_needs_no_shuffle_after_join(spark, no_broadcast):
    plan = _plan(E.queries()["agg_daily_revenue"](spark, SF001))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert not any("order_id" in e and "order_date" in e for e in exchanges)
    assert "Expand" not in plan


def test_dedupe_limits_before_shuffle(spark):
    plan = _plan(E.queries()["latest_per_key_lineitem"](spark, SF001))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scd2_run_is_one_join(spark, no_broadcast):
    plan = _plan(E.queries()["scd2_timestamp"](spark, SF001))
    assert plan.count("SortMergeJoin") == 1 and "Generate inline" in plan
