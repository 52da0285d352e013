"""Sample views for every operator, built from the base tables.

Each function takes ``(spark, base)`` where ``base`` is the folder with one Parquet table per name,
and returns a lazy DataFrame. Nulls and malformed text are planted by key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


# Purpose code by ``key % 13``; the last one is not in the lookup.
_CODES = (
    "credit_card", "medical", "major_purchase", "renewable_energy", "small_business", "debt_consolidation",
    "vacation", "house", "other", "home_improvement", "moving", "car", "wedding",
)

_LOANS = {
    "member_id": "o_orderkey",
    "zip_code": "if(o_orderkey % 97 = 0, NULL, concat(lpad(string(o_orderkey * 37 % 1000), 3, '0'), 'xx'))",
    "addr_state": "if(o_orderkey % 71 = 0, NULL, concat('S', o_custkey % 50))",
    "grade": "if(o_orderkey % 53 = 0, NULL, substr('ABCDEFG', int(1 + o_custkey % 7), 1))",
    "sub_grade": "concat(substr('ABCDEFG', int(1 + o_custkey % 7), 1), 1 + o_orderkey % 5)",
    "loan_amnt": "string(bigint(floor(o_totalprice)))",
    "funded_amnt": "string(bigint(floor(o_totalprice)))",
    "term": "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END",
    "int_rate": "if(o_orderkey % 89 = 0, 'n/a', concat(5 + o_custkey % 20, '.', lpad(string(o_orderkey % 100), 2, '0'), '%'))",
    "emp_title": "concat('title ', o_custkey % 30)",
    "emp_length": "concat(o_custkey % 10, ' years')",
    "annual_inc": "string(20000 + o_custkey * 131 % 150000)",
    "loan_status": "CASE WHEN o_orderstatus = 'F' THEN 'Fully Paid' WHEN o_orderstatus = 'O' THEN 'Current'"
    " WHEN o_orderpriority = '1-URGENT' THEN 'Charged Off' WHEN o_orderpriority = '2-HIGH' THEN 'Late (31-120 days)'"
    " WHEN o_orderpriority = '3-MEDIUM' THEN 'In Grace Period' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL"
    " ELSE 'Default' END",
    "purpose": "element_at(array({codes}), int(1 + o_orderkey % 13))".format(codes=", ".join(f"'{c}'" for c in _CODES)),
    "title": "concat('loan ', o_orderkey % 13)",
    "dti": "string(o_custkey % 40)",
    "out_prncp": "if(o_orderstatus = 'F', '0', string(bigint(floor(o_totalprice / 2))))",
    "bc_util": "if(o_orderkey % 41 = 0, 'NA', string(o_custkey * 7 % 100))",
    "bc_open_to_buy": "if(o_orderkey % 43 = 0, NULL, string(o_custkey * 311 % 50000))",
    "all_util": "if(o_orderkey % 47 = 0, NULL, string(o_orderkey * 3 % 110))",
}


def loans(spark: SparkSession, base: str) -> DataFrame:
    """Loan table; key ``member_id``. All measures are text, as in the source table."""
    return table(spark, base, "orders").selectExpr(*[f"{text} AS {name}" for name, text in _LOANS.items()])


def office_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Zip to region and office; some zips are missing and some are listed under two regions."""
    n = F.col("n")
    zips = (
        loans(spark, base)
        .where(F.col("zip_code").isNotNull())
        .select("zip_code")
        .distinct()
        .select("zip_code", F.substring("zip_code", 1, 3).alias("office_no"))
        .select("zip_code", "office_no", F.col("office_no").cast("int").alias("n"))
        .where(n % 50 != 0)
    )
    first = (
        F.when(n >= 800, "West")
        .when(n >= 700, "South")
        .when(n >= 400, "Midwest")
        .when(n >= 200, "South")
        .otherwise("East")
    )
    second = F.when(n >= 800, "East").when((n >= 400) & (n < 700), "South").otherwise("West")
    listed = F.when(n % 12 == 0, F.array(first, second)).otherwise(F.array(first))
    return zips.select(F.explode(listed).alias("region"), "zip_code", "office_no")


def wine(spark: SparkSession, base: str) -> DataFrame:
    """Wine measurements with a quality score; key ``wine_id``, ``color`` red or white.

    ``citric_acid`` is sometimes missing; ``cellar`` is a key that many rows share and some lack.
    """
    price, cust, key = F.col("o_totalprice"), F.col("o_custkey"), F.col("o_orderkey")
    share = lambda c, n, by: (c % n).cast("double") / by
    return table(spark, base, "orders").select(
        key.alias("wine_id"),
        F.when(F.col("o_orderstatus") == "F", "red").otherwise("white").alias("color"),
        (price / 100000.0).alias("alcohol"),
        share(cust, 97, 10.0).alias("ph"),
        F.month("o_orderdate").cast("double").alias("sulphates"),
        share(cust, 53, 10.0).alias("fixed_acidity"),
        share(key, 31, 20.0).alias("volatile_acidity"),
        F.when(key % 59 != 0, share(cust, 13, 15.0)).alias("citric_acid"),
        share(key, 101, 7.0).alias("residual_sugar"),
        share(cust, 7, 70.0).alias("chlorides"),
        share(key, 61, 1.0).alias("free_so2"),
        share(cust, 41, 1.0).alias("total_so2"),
        (0.99 + share(key, 17, 1000.0)).alias("density"),
        F.when(key % 5 != 0, key % 7).alias("cellar"),
        (3 + F.floor(price / 100000.0) + cust % 2).cast("int").alias("quality"),
    )


def reds(spark: SparkSession, base: str) -> DataFrame:
    return wine(spark, base).where(F.col("color") == "red")


def whites(spark: SparkSession, base: str) -> DataFrame:
    return wine(spark, base).where(F.col("color") == "white")


def partsupp(spark: SparkSession, base: str) -> DataFrame:
    """Supply cost per part and supplier; key ``ps_partkey, ps_suppkey``."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return (
        table(spark, base, "lineitem")
        .select("l_partkey", "l_suppkey")
        .distinct()
        .select(
            part.alias("ps_partkey"),
            supp.alias("ps_suppkey"),
            (((part * 7 + supp * 13) % 1000).cast("double") / 10.0).alias("ps_supplycost"),
        )
    )


#: The predictors of the wine fits and of the diagnosis fits.
WINE = ("fixed_acidity", "volatile_acidity", "citric_acid", "residual_sugar", "chlorides", "free_so2", "total_so2", "density", "ph", "sulphates", "alcohol")
BREAST = ("mean_radius", "mean_texture", "mean_area", *(f"measure_{i}" for i in range(3, 64)))


def iris_like(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("species"),
        (F.col("p_size").cast("double") / 10.0).alias("sepal_width"),
        (F.col("p_retailprice") / 100.0).alias("sepal_length"),
    )


def breast_like(spark: SparkSession, base: str) -> DataFrame:
    values = [F.get("embedding", F.lit(i)).cast("double").alias(name) for i, name in enumerate(BREAST)]
    return table(spark, base, "embeddings").select("vec_id", *values, (F.col("label") % 2).alias("target"))


def kidney_like(spark: SparkSession, base: str) -> DataFrame:
    """Times with right censoring: ``censored = 1`` means the event was not seen."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, base, "orders").select(
        key.alias("id"),
        cust.alias("patient"),
        (F.col("o_totalprice") / 1000.0).alias("time"),
        F.when(key % 4 == 0, 1).otherwise(0).alias("censored"),
        (20 + cust % 60).cast("int").alias("age"),
        F.when(cust % 2 == 0, "female").otherwise("male").alias("sex"),
        F.when(key % 5 == 0, "GN")
        .when(key % 5 == 1, "AN")
        .when(key % 5 == 2, "PKD")
        .otherwise("other")
        .alias("disease"),
    )


def schools(spark: SparkSession) -> DataFrame:
    """The eight-schools inputs: effect and standard error per school."""
    # Published treatment effects and standard errors.
    y = (28, 8, -3, 7, -1, 1, 18, 12)
    sigma = (15, 10, 16, 11, 9, 11, 10, 18)
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(y, sigma))]
    return spark.createDataFrame(rows, "id int, y double, sigma double")


def customer_effects(spark: SparkSession, base: str) -> DataFrame:
    """Mean order value and its standard error per customer, in thousands: ``id, y, sigma``.

    A customer with one order or without spread gets the error that the pooled within-customer variance gives.
    """
    price = F.col("o_totalprice") / 1000.0
    per = table(spark, base, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.avg(price).alias("y"), F.var_samp(price).alias("v"), F.count(price).alias("n"))
    pooled = per.agg((F.sum((F.col("n") - 1) * F.col("v")) / F.sum(F.when(F.col("v").isNotNull(), F.col("n") - 1))).alias("v")).scalar()
    variance = F.when(F.col("v") > 0, F.col("v")).otherwise(pooled)
    return per.select("id", "y", F.sqrt(variance / F.col("n")).alias("sigma"))


def draws(spark: SparkSession, base: str) -> DataFrame:
    """Posterior draws ``(chain, iter, param, value)``."""
    key = F.col("o_orderkey")
    return table(spark, base, "orders").select(
        (key % 4).alias("chain"),
        F.floor(key / 32).cast("bigint").alias("iter"),
        (F.floor(key / 4).cast("bigint") % 8).alias("param"),
        (F.col("o_totalprice") / 10000.0).alias("value"),
    )


def loglik(spark: SparkSession, base: str) -> DataFrame:
    """Point-wise log-likelihood rows ``(draw, obs, ll)``."""
    key = F.col("o_orderkey")
    return table(spark, base, "orders").select(
        (key % 50).alias("draw"),
        F.floor(key / 50).cast("bigint").alias("obs"),
        (-F.col("o_totalprice") / 100000.0).alias("ll"),
    )


#: The three (alpha, lambda) pairs of the elastic-net runs.
WINE_RUNS = ((0.03, 0.98), (0.14, 0.40), (0.20, 0.99))
