"""What the plans of the queries must and must not contain."""

import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["join_orders_items", "join_items_products", "silver_sales", "agg_rfm_base", "agg_rfm_from_silver",
     "ntile_monetary", "upsert_orders", "dedup_latest"],
)
def test_no_cross_join_and_no_python(spark, name):
    plan = _plan(registered.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert operator not in plan


def test_filter_and_columns_reach_the_scan(spark):
    plan = _plan(registered.agg_global_max(spark, SF_DIR))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,F))]" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_metrics_read_only_what_they_need(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = _plan(registered.agg_rfm_base(spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_tax:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    # The reference date needs the orders alone: its part of the plan joins nothing.
    subquery = plan[plan.index("Subquery"):plan.index("+- HashAggregate(keys=[customer_unique_id")]
    assert "Join" not in subquery and "o_orderdate" in subquery


def test_items_collapse_before_they_move(spark):
    plan = _plan(registered.agg_rfm_base(spark, SF_DIR))
    assert "HashAggregate(keys=[order_id" in plan and "partial_sum((price" in plan


def test_top_customers_use_a_bounded_sort(spark):
    plan = _plan(registered.top_segment_customers(spark, SF_DIR))
    assert "TakeOrderedAndProject(limit=10" in plan


def test_narrowed_scores_need_no_shuffle(spark):
    plan = _plan(registered.queries()["ntile_monetary"](spark, "/root/testdata/sf0.01"))
    assert "Exchange" not in plan and "Window" not in plan
