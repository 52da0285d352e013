"""Queries over parts, orders and measurements: profit report, summary, sampling, metrics, row hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.functions import hashing as H
from tallyforge.operators import joins, metrics, profit, sampling, summary
from tallyforge.plans.registry import query
from tallyforge.session import remove_path, work_path, written
from tallyforge.sources import tables, views

#: Buckets of the clones of line items and orders.
BUCKETS = 16


def profit_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    named = {n: views.table(spark, base, n) for n in ("part", "supplier", "lineitem", "orders", "nation")}
    return {**named, "partsupp": views.partsupp(spark, base)}


PROFIT_FROM = """
FROM lineitem li
JOIN (SELECT p_partkey FROM part WHERE left(p_name, 1) IN ('a', 'b')) chosen ON chosen.p_partkey = li.l_partkey
JOIN partsupp ps ON ps.ps_partkey = li.l_partkey AND ps.ps_suppkey = li.l_suppkey
JOIN orders o ON o.o_orderkey = li.l_orderkey
JOIN supplier s ON s.s_suppkey = li.l_suppkey
JOIN nation n ON n.n_nationkey = s.s_nationkey
"""
AMOUNT = "l_extendedprice * (1 - l_discount) - ps_supplycost * l_quantity"
REPORT_SQL = f"""
SELECT n_name AS nation, CAST(extract(year FROM o_orderdate) AS INT) AS o_year, round(sum({AMOUNT}), 4) AS sum_profit
{PROFIT_FROM} GROUP BY ALL
"""


@query(
    "join_q9",
    f"SELECT n_name AS nation, CAST(extract(year FROM o_orderdate) AS INT) AS o_year, round({AMOUNT}, 4) AS amount {PROFIT_FROM}",
    ("partsupp",),
)
def join_q9(spark, base):
    return profit.profit_rows(profit_tables(spark, base)).withColumn("amount", F.round("amount", 4))


@query("agg_q9", REPORT_SQL, ("partsupp",))
def agg_q9(spark, base):
    report = profit.profit_by_nation(profit_tables(spark, base))
    return report.withColumn("sum_profit", F.round("sum_profit", 4))


@query("topk_q9", f"SELECT * FROM ({REPORT_SQL}) ORDER BY nation, o_year DESC LIMIT 1", ("partsupp",))
def topk_q9(spark, base):
    return profit.top_profit(agg_q9(spark, base))


@query("agg_q9_bucketed", REPORT_SQL, ("partsupp",))
def agg_q9_bucketed(spark, base):
    """The report over bucketed clones of line items and orders, which meet without being moved; the clones are dropped afterwards."""
    frames, names = profit_tables(spark, base), []
    try:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            names.append((f"{name}_{uuid.uuid4().hex}", work_path(spark, name)))
            frames[name] = tables.clone_bucketed(frames[name], names[-1][0], key, BUCKETS, names[-1][1])
        report = profit.profit_by_nation(frames).withColumn("sum_profit", F.round("sum_profit", 4))
        return written(report, "report")
    finally:
        for name, path in names:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            remove_path(spark, path)


SQL_TEXT = """
WITH chosen AS (SELECT p_partkey FROM {part} WHERE startswith(p_name, 'a') OR startswith(p_name, 'b')),
priced AS (
  SELECT li.l_orderkey, li.l_suppkey, li.l_extendedprice * (1 - li.l_discount) - ps.ps_supplycost * li.l_quantity AS gain
  FROM {lineitem} li
  JOIN chosen ON chosen.p_partkey = li.l_partkey
  JOIN {partsupp} ps ON ps.ps_partkey = li.l_partkey AND ps.ps_suppkey = li.l_suppkey
)
SELECT n.n_name AS nation, year(o.o_orderdate) AS o_year, sum(priced.gain) AS sum_profit
FROM priced
JOIN {orders} o ON o.o_orderkey = priced.l_orderkey
JOIN {supplier} s ON s.s_suppkey = priced.l_suppkey
JOIN {nation} n ON n.n_nationkey = s.s_nationkey
GROUP BY n.n_name, year(o.o_orderdate)
ORDER BY nation, o_year DESC
"""


@query("src_sql", REPORT_SQL, ("partsupp",))
def src_sql(spark, base):
    report = tables.run_sql(spark, SQL_TEXT, **profit_tables(spark, base))
    return report.select("nation", F.col("o_year").cast("int"), F.round("sum_profit", 4).alias("sum_profit"))


@query("sort_multi", f"{REPORT_SQL} ORDER BY nation, o_year DESC", ("partsupp",))
def sort_multi(spark, base):
    return profit.sorted_report(agg_q9(spark, base))


@query(
    "filter_like_prefix",
    "SELECT p_partkey, p_name FROM part WHERE left(p_name, 1) IN ('a', 'b')",
)
def filter_like_prefix(spark, base):
    return views.table(spark, base, "part").where(C.starts_with_any("p_name", ("b", "a"))).select("p_partkey", "p_name")


@query(
    "profit_expr",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_extendedprice * l_discount - 0.5 * l_quantity, 4) AS amount FROM lineitem",
)
def profit_expr(spark, base):
    amount = C.profit("l_extendedprice", "l_discount", F.lit(0.5), "l_quantity")
    return views.table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", F.round(amount, 4).alias("amount"))


SUMMARY_SQL = """
SELECT species, sepal_width, count, round(m, 6) AS mean, round(s, 6) AS stdev, round(m - s, 6) AS lower, round(m + s, 6) AS upper
FROM (SELECT species, round(sepal_width * 2) / 2 AS sepal_width, count(*) AS count, avg(sepal_length) AS m, stddev_samp(sepal_length) AS s
      FROM iris_like GROUP BY 1, 2)
"""


@query("agg_bucket_summary", SUMMARY_SQL, ("iris_like",))
def agg_bucket_summary(spark, base):
    out = summary.bucket_summary(views.iris_like(spark, base), "species", "sepal_width", "sepal_length")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stdev", "lower", "upper")})


@query("bucket_half", "SELECT id, round(sepal_width * 2) / 2 AS bucket FROM iris_like", ("iris_like",))
def bucket_half(spark, base):
    return views.iris_like(spark, base).select("id", C.bucket_half("sepal_width").alias("bucket"))


@query("union_all", "SELECT wine_id, color, quality FROM wine", ("wine",))
def union_all(spark, base):
    stacked = joins.union_all(views.reds(spark, base), views.whites(spark, base))
    return stacked.select("wine_id", "color", "quality")


RANK_SQL = "SELECT *, row_number() OVER (ORDER BY md5(CAST(wine_id AS STRING) || ':42'), wine_id) AS r, count(*) OVER () AS n FROM wine"


@query("sample_n", f"SELECT wine_id, quality FROM ({RANK_SQL}) WHERE r <= 2000", ("wine",))
def sample_n(spark, base):
    return sampling.sample_n(views.wine(spark, base), "wine_id", 2000).select("wine_id", "quality")


@query("split_exact", f"SELECT wine_id, r <= floor(0.75 * n) AS is_train FROM ({RANK_SQL})", ("wine",))
def split_exact(spark, base):
    return sampling.mark_split(views.wine(spark, base), "wine_id").select("wine_id", "is_train")


@query("global_rank", f"SELECT wine_id, r AS rank FROM ({RANK_SQL})", ("wine",))
def global_rank(spark, base):
    return sampling.global_rank(views.wine(spark, base), "wine_id", unique=True).select("wine_id", "rank")


@query(
    "split_ordered",
    "SELECT vec_id, row_number() OVER (ORDER BY vec_id) <= floor(0.7 * count(*) OVER ()) AS is_train FROM breast_like",
    ("breast_like",),
)
def split_ordered(spark, base):
    return sampling.mark_split_ordered(views.breast_like(spark, base), "vec_id").select("vec_id", "is_train")


@query(
    "split_hash",
    "SELECT wine_id, CAST('0x' || substr(md5(CAST(wine_id AS STRING) || ':42'), 1, 4) AS INT) < 49152 AS is_train FROM wine",
    ("wine",),
)
def split_hash(spark, base):
    return sampling.mark_split_hash(views.wine(spark, base), "wine_id").select("wine_id", "is_train")


@query("except_rows", f"SELECT wine_id, quality FROM ({RANK_SQL}) WHERE r > floor(0.75 * n)", ("wine",))
def except_rows(spark, base):
    wine = views.wine(spark, base)
    train, _ = sampling.split_exact(wine, "wine_id")
    return joins.except_rows(wine.select("wine_id", "quality"), train.select("wine_id", "quality"))


HASH_INT_SQL = "CAST('0x' || substr(md5(CAST({key} AS STRING) || ':{seed}'), 1, 8) AS BIGINT)"


@query(
    "kfold",
    f"SELECT wine_id, CAST({HASH_INT_SQL.format(key='wine_id', seed=42)} % 10 AS INT) AS fold FROM wine",
    ("wine",),
)
def kfold(spark, base):
    return sampling.with_folds(views.wine(spark, base), "wine_id").select("wine_id", "fold")


@query(
    "sample_label",
    f"SELECT o_orderkey, CAST({HASH_INT_SQL.format(key='o_orderkey', seed='label')} % 2 AS INT) AS label FROM orders",
)
def sample_label(spark, base):
    return views.table(spark, base, "orders").select("o_orderkey", H.pick("o_orderkey", [0, 1], "label").alias("label"))


@query(
    "choice_param",
    f"SELECT o_orderkey, CAST({HASH_INT_SQL.format(key='o_orderkey', seed='b')} % 3 + 1 AS INT) AS b FROM orders",
)
def choice_param(spark, base):
    return views.table(spark, base, "orders").select("o_orderkey", H.pick("o_orderkey", [1, 2, 3], "b").alias("b"))


@query(
    "metric_rmse_mae_r2",
    "SELECT color, round(sqrt(avg((p - quality) * (p - quality))), 6) AS rmse, round(avg(abs(p - quality)), 6) AS mae,"
    " round(corr(p, quality) * corr(p, quality), 6) AS r2 FROM (SELECT color, quality, 2 + alcohol AS p FROM wine) GROUP BY color",
    ("wine",),
)
def metric_rmse_mae_r2(spark, base):
    scored = views.wine(spark, base).withColumn("p", 2.0 + F.col("alcohol"))
    out = metrics.regression_metrics(scored, "p", "quality", ("color",))
    return out.select("color", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@query(
    "metric_logloss_error",
    "SELECT round(-avg(CASE WHEN target = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS logloss,"
    " round(avg(CASE WHEN (p > 0.5) = (target = 1) THEN 0 ELSE 1 END), 6) AS error"
    " FROM (SELECT target, greatest(least(1 / (1 + exp(-mean_radius * 3)), 1 - 1e-15), 1e-15) AS p FROM breast_like)",
    ("breast_like",),
)
def metric_logloss_error(spark, base):
    scored = views.breast_like(spark, base).withColumn("p", 1.0 / (1.0 + F.exp(F.col("mean_radius") * -3.0)))
    return metrics.binary_metrics(scored, "p", "target").select(*[F.round(c, 6).alias(c) for c in ("logloss", "error")])


@query(
    "agg_best",
    "SELECT sulphates, round(mae, 6) AS mae FROM (SELECT sulphates, avg(abs(2 + alcohol - quality)) AS mae FROM wine GROUP BY 1) ORDER BY mae, sulphates LIMIT 1",
    ("wine",),
)
def agg_best(spark, base):
    scored = views.wine(spark, base).withColumn("p", 2.0 + F.col("alcohol"))
    by_month = metrics.regression_metrics(scored, "p", "quality", ("sulphates",))
    return metrics.best_row(by_month, "mae", "sulphates").select("sulphates", F.round("mae", 6).alias("mae"))


@query("preview", "SELECT wine_id, color, quality FROM wine ORDER BY wine_id LIMIT 6", ("wine",))
def preview(spark, base):
    return views.wine(spark, base).select("wine_id", "color", "quality").orderBy("wine_id").limit(6)


@query(
    "filter_equi",
    "SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, s_nationkey FROM lineitem, orders, supplier"
    " WHERE o_orderkey = l_orderkey AND s_suppkey = l_suppkey",
)
def filter_equi(spark, base):
    lines = views.table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = views.table(spark, base, "orders").select("o_orderkey", "o_orderstatus")
    suppliers = views.table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    joined = lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "s_nationkey"
    )


@query("join_anti_split", f"SELECT wine_id, color FROM ({RANK_SQL}) WHERE r > 2000", ("wine",))
def join_anti_split(spark, base):
    """The rest of a sample, from the sample's own mark."""
    _, rest = sampling.split_n(views.wine(spark, base), "wine_id", 2000)
    return rest.select("wine_id", "color")


CELLAR_SQL = """
WITH counted AS (SELECT cellar, count(*) AS c FROM wine GROUP BY cellar),
ordered AS (SELECT cellar, c, coalesce(sum(c) OVER (ORDER BY md5(coalesce(CAST(cellar AS STRING), '') || ':42') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  (SELECT floor(0.75 * count(*)) FROM wine) AS size FROM counted)
SELECT cellar, CAST(c AS BIGINT) AS n, CAST(greatest(0, least(c, size - before)) AS BIGINT) AS n_train FROM ordered
"""


@query("split_repeated_keys", CELLAR_SQL, ("wine",))
def split_repeated_keys(spark, base):
    """A split by a key that many rows share and some lack: sizes per key of both parts, the rest taken by subtraction."""
    wine = views.wine(spark, base).select("wine_id", "cellar", "quality")
    train, _ = sampling.split_exact(wine, "cellar")
    rest = joins.except_rows(wine, train)
    marked = joins.union_all(train.withColumn("t", F.lit(1)), rest.withColumn("t", F.lit(0)))
    return marked.groupBy("cellar").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("n_train"))


@query("as_label", "SELECT vec_id, CASE WHEN target = 1 THEN 1 ELSE 0 END AS label FROM breast_like", ("breast_like",))
def as_label(spark, base):
    return views.breast_like(spark, base).select("vec_id", C.as_label(F.col("target") == 1).alias("label"))


@query("src_packaged", "SELECT disease, sex, censored, count(*) AS n, min(age) AS youngest, max(time) AS longest FROM kidney_like GROUP BY ALL", ("kidney_like",))
def src_packaged(spark, base):
    return (
        views.kidney_like(spark, base)
        .groupBy("disease", "sex", "censored")
        .agg(F.count(F.lit(1)).alias("n"), F.min("age").alias("youngest"), F.max("time").alias("longest"))
    )
