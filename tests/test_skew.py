"""One key with a third of all rows: joins are split, aggregations merge before the shuffle."""

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import draws, joins, order_stats, profit, sampling

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def no_broadcast(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_hot_order_in_the_profit_join(spark, no_broadcast):
    lines = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        (F.col("id") % 50).alias("l_partkey"), (F.col("id") % 4).alias("l_suppkey"),
        (10.0 + F.rand(2)).alias("l_extendedprice"), F.lit(0.5).alias("l_discount"), F.lit(1.0).alias("l_quantity"),
    ).repartition(8)
    frames = {
        "part": spark.range(50).select(F.col("id").alias("p_partkey"), F.lit("bolt").alias("p_name")),
        "lineitem": lines,
        "partsupp": lines.select("l_partkey", "l_suppkey").distinct().select(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey"), F.lit(2.0).alias("ps_supplycost")),
        "orders": spark.range(5000).select(F.col("id").alias("o_orderkey"), F.lit("1995-01-01").cast("date").alias("o_orderdate")),
        "supplier": spark.range(4).select(F.col("id").alias("s_suppkey"), F.lit(1).alias("s_nationkey")),
        "nation": spark.range(1, 2).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("N").alias("n_name")),
    }
    report = profit.profit_by_nation(frames)
    assert "skew=true" in final_plan(report)
    assert report.first()["sum_profit"] == pytest.approx(60000 * (5.25 - 2.0), rel=0.01)


def test_hot_group_total(spark, no_broadcast):
    rows = spark.range(60000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 999).alias("g"), F.lit(1.0).alias("v"))
    out = joins.with_group_total(rows, ("g",), F.col("v"), "total", max_rows=10)
    assert out.columns == ["id", "g", "v", "total"]
    counts = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count("v").alias("n")).collect()}
    assert all(r["total"] == counts[r["g"]] for r in out.select("g", "total").distinct().collect())
    assert out.count() == 60000
    assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()


def test_summaries_with_more_groups_than_are_broadcast(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(order_stats, "checked_broadcast", lambda df: joins.checked_broadcast(df, 3))
    rows = spark.range(6000).select(
        (F.col("id") % 2).alias("chain"), (F.floor(F.col("id") / 2) % 500).alias("iter"), F.floor(F.col("id") / 1000).alias("param"),
        (F.col("id") * 7919 % 1009).cast("double").alias("value"),
    )
    found = {r["param"]: r for r in draws.draws_summary(rows).collect()}
    exact = {r["param"]: r for r in rows.groupBy("param").agg(F.median("value").alias("m"), F.avg("value").alias("a")).collect()}
    assert set(found) == set(exact) == set(range(6))
    for p, r in exact.items():
        assert found[p]["q50"] == pytest.approx(r["m"]) and found[p]["mean"] == pytest.approx(r["a"])
    assert draws.split_rhat(rows).where("rhat > 0").count() == 6
    assert draws.effective_size(rows, 10, 100).count() == 6


def test_hot_value_does_not_reach_one_task(spark):
    """Rows with the hot value are merged on the map side before they are shuffled."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(1) * 10).alias("v")).repartition(4)
    out = order_stats.exact_median(df, "v")
    assert out.first()[0] == pytest.approx(df.agg(F.median("v")).first()[0])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_one_long_chain_is_spread(spark):
    rows = spark.range(50000).select(
        F.lit(0).alias("chain"), F.col("id").alias("iter"), F.lit("p").alias("param"), F.rand(3).alias("value")
    )
    sums = draws.autocovariances(rows, 11, 0, 1000)
    direct = rows.agg(F.var_pop("value")).first()[0]
    found = {r["lag"]: r["acov"] for r in sums.collect()}
    assert found[0] == pytest.approx(direct) and len(found) == 11
    assert all(abs(found[t]) < 0.01 for t in range(1, 11))


def test_split_shuffles_one_bucket_only(spark):
    """Without a group-by on the rows themselves, the marked rows keep their partitions."""
    df = spark.range(1000).repartition(7)
    assert sampling.mark_split(df, "id").rdd.getNumPartitions() == 7
