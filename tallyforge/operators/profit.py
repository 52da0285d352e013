"""Profit by nation and year over parts, suppliers, line items, supply costs and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import profit, starts_with_any

PREFIXES = ("b", "a")


def profit_rows(tables: dict[str, DataFrame], prefixes: tuple[str, ...] = PREFIXES) -> DataFrame:
    """One row per line item of the selected parts: ``nation, o_year, amount``.

    ``tables`` holds part, supplier, lineitem, partsupp, orders and nation. The part filter reaches the
    scan and shrinks the line items before any other join.
    """
    parts = tables["part"].where(starts_with_any("p_name", prefixes)).select("p_partkey")
    lines = tables["lineitem"].join(parts, F.col("l_partkey") == F.col("p_partkey"))
    cost = (F.col("ps_partkey") == F.col("l_partkey")) & (F.col("ps_suppkey") == F.col("l_suppkey"))
    return (
        lines.join(tables["partsupp"], cost)
        .join(tables["orders"], F.col("o_orderkey") == F.col("l_orderkey"))
        .join(tables["supplier"], F.col("s_suppkey") == F.col("l_suppkey"))
        .join(tables["nation"], F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            F.col("n_name").alias("nation"),
            F.year("o_orderdate").alias("o_year"),
            profit("l_extendedprice", "l_discount", "ps_supplycost", "l_quantity").alias("amount"),
        )
    )


def profit_by_nation(tables: dict[str, DataFrame], prefixes: tuple[str, ...] = PREFIXES) -> DataFrame:
    """Summed profit by nation and year.

    Line items are summed per part, supplier and year before supply costs are looked up: the sum of
    ``price * (1 - discount) - cost * quantity`` needs only the summed revenue and quantity of a pair.
    A part that holds a large share of all rows is thus merged on the map side, and the joins with
    costs, suppliers and nations run on one row per pair and year.
    """
    parts = tables["part"].where(starts_with_any("p_name", prefixes)).select("p_partkey")
    pairs = (
        tables["lineitem"]
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(tables["orders"], F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("l_partkey", "l_suppkey", F.year("o_orderdate").alias("o_year"))
        .agg(
            F.sum(F.col("l_extendedprice") * (1.0 - F.col("l_discount"))).alias("revenue"),
            F.sum("l_quantity").alias("quantity"),
        )
    )
    cost = (F.col("ps_partkey") == F.col("l_partkey")) & (F.col("ps_suppkey") == F.col("l_suppkey"))
    home = tables["supplier"].join(tables["nation"], F.col("n_nationkey") == F.col("s_nationkey"))
    return (
        pairs.join(tables["partsupp"], cost)
        .groupBy("l_suppkey", "o_year")
        .agg(F.sum(F.col("revenue") - F.col("ps_supplycost") * F.col("quantity")).alias("amount"))
        .join(home.select("s_suppkey", "n_name"), F.col("s_suppkey") == F.col("l_suppkey"))
        .groupBy(F.col("n_name").alias("nation"), "o_year")
        .agg(F.sum("amount").alias("sum_profit"))
    )


def sorted_report(report: DataFrame) -> DataFrame:
    """Nation ascending, year descending."""
    return report.orderBy(F.col("nation").asc(), F.col("o_year").desc())


def top_profit(report: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` rows of :func:`sorted_report`, without a full sort."""
    return sorted_report(report).limit(n)
