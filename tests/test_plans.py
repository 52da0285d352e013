"""What reaches the scan, and what must not be in a plan."""

import pytest

from __spark_entry__ import queries
from tallyforge.operators import profit
from tallyforge.plans.table_queries import profit_tables


def plan(spark, df) -> str:
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_prefix_and_columns_reach_the_scan(spark, base):
    text = plan(spark, profit.profit_by_nation(profit_tables(spark, base)))
    assert "Or(StringStartsWith(p_name,b),StringStartsWith(p_name,a))" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:" in text
    assert "l_tax" not in text and "o_totalprice" not in text


def test_top_row_needs_no_full_sort(spark, base):
    assert "TakeOrderedAndProject" in plan(spark, queries()["topk_q9"](spark, base))


@pytest.mark.parametrize(
    "name", ["agg_risk_share", "agg_principal_chart", "join_left_totals", "kpi_median_amount", "split_exact", "grid_objective", "cross_grid"]
)
def test_no_cross_join_and_no_window_over_the_groups(spark, base, name):
    text = plan(spark, queries()[name](spark, base))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "windowspecdefinition(region" not in text


def test_risk_share_is_one_aggregation(spark, base):
    text = plan(spark, queries()["agg_risk_share"](spark, base))
    assert text.count("Exchange hashpartitioning(region") == 1 and "Window" not in text


def test_pooling_does_not_shuffle_grid_rows_by_group(spark, base):
    text = plan(spark, queries()["agg_pool_groups"](spark, base))
    assert "Exchange hashpartitioning(id" not in text
