"""A rollup of the loans for the dashboard: refreshes read it instead of the loans.

Three tables by the columns that filters and groups use. ``cells`` holds additive sums. ``bins`` and ``amounts`` are a
histogram of the loan amounts that can be merged: ``bins`` counts amounts per quarter of an octave, ``amounts`` counts
equal ones and is laid out by bin. The exact median finds its bin among the counts and reads that bin alone. A batch of
loans is rolled up once and stored as partitions of its own, and storing it again replaces them, so a repeated refresh
changes nothing. The size of ``cells`` and ``bins`` is bounded by the numbers of zips, purposes and grades.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.columns import millions, not_in_keep_null, parse_rate, region_prefixes, term_to_months, to_numeric
from tallyforge.functions.text import money
from tallyforge.operators.filters import Selection, loan_base
from tallyforge.operators.joins import semi_lookup
from tallyforge.sources.lookups import PURPOSES, SETTLED_STATUSES, SUB_GRADES

#: What filters and groups look at.
FILTERS = ("zip_code", "purpose", "sub_grade")
KEYS = ("region", "grade", *FILTERS)
SUMS = ("principal", "risk_principal", "rate", "months")
_TEXTS = ", ".join(f"{c} string" for c in (*FILTERS, "region"))
#: The tables as they are read; the batch, and the bin of an amount, are folders.
SCHEMAS = {
    "cells": f"{_TEXTS}, grade string, loans bigint, risk_loans bigint, {', '.join(f'{c}_sum double, {c}_n bigint' for c in SUMS)}, batch string",
    "amounts": f"{_TEXTS}, amount double, n bigint, batch string, bin int",
    "bins": f"{_TEXTS}, bin int, n bigint, batch string",
}
#: Bins of the histogram in an octave.
STEPS = 4


def amount_bin(amount: Column) -> Column:
    """A number that never falls with the amount; at most about 8,200 different ones."""
    return (F.signum(amount) * F.floor(F.log2(F.abs(amount) + 1.0) * STEPS)).cast("int")


def append_batch(loans: DataFrame, path: str, batch: str) -> None:
    """Rolls a batch of loans up into the tables below ``path``; a batch of that name is replaced.

    Loans that no report shows, without a state or a known region, are left out, like in
    :func:`tallyforge.operators.filters.loan_base`.
    """
    base = loan_base(loans).withColumns({"amount": to_numeric("loan_amnt"), "rate": parse_rate("int_rate"), "months": term_to_months("term")})
    at_risk = not_in_keep_null("loan_status", SETTLED_STATUSES)
    sums = {"principal": F.col("out_prncp"), "risk_principal": F.when(at_risk, F.col("out_prncp")), "rate": F.col("rate"), "months": F.col("months").cast("double")}
    cells = base.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("loans"),
        F.count_if(at_risk).alias("risk_loans"),
        *[F.sum(v).alias(f"{k}_sum") for k, v in sums.items()],
        *[F.count(v).alias(f"{k}_n") for k, v in sums.items()],
    )
    # rows of one amount are merged where they lie, so neither a hot zip nor a hot amount meets in one task as rows
    amounts = base.where(F.col("amount").isNotNull()).groupBy(*FILTERS, "region", "amount").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", amount_bin(F.col("amount")))
    if not re.fullmatch("[A-Za-z0-9_-]+", batch):
        raise ValueError(f"batch name {batch!r} is not letters, digits, _ and -")
    place = {name: f"{path}/{name}/batch={batch}" for name in ("cells", "amounts", "bins")}
    cells.write.mode("overwrite").parquet(place["cells"])
    amounts.write.mode("overwrite").partitionBy("bin").parquet(place["amounts"])
    kept = loans.sparkSession.read.schema(amounts.schema).parquet(place["amounts"])
    kept.groupBy(*FILTERS, "region", "bin").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(place["bins"])


class Rollup:
    """The reports of :mod:`tallyforge.operators.dashboard` from a rollup, for a selection or for all loans (``None``)."""

    def __init__(self, spark: SparkSession, path: str, offices: DataFrame) -> None:
        self.spark, self.path, self.offices = spark, path, offices

    def _table(self, name: str, selection: Selection | None) -> DataFrame:
        rows = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}")
        if selection is None:
            return rows
        picked = rows.where(F.col("purpose").isin(*(selection.purposes or PURPOSES)) & F.col("sub_grade").isin(*(selection.sub_grades or SUB_GRADES)))
        if selection.regions:
            picked = picked.where(region_prefixes("zip_code", selection.regions))
        if selection.zip_codes:
            return picked.where(F.col("zip_code").isin(*selection.zip_codes))
        return semi_lookup(picked, self.offices, "zip_code")

    def principal(self, selection: Selection | None = Selection()) -> DataFrame:
        """Outstanding principal by region and grade; NULL for a group without any value."""
        return self._table("cells", selection).groupBy("region", "grade").agg(F.sum("principal_sum").alias("out_prncp"))

    def principal_chart(self, selection: Selection | None = Selection()) -> DataFrame:
        total = F.coalesce(F.col("out_prncp"), F.lit(0.0))
        return self.principal(selection).select("region", "grade", total.alias("out_prncp"), millions(total).alias("out_prncp_m"))

    def risk_share(self, selection: Selection | None = Selection()) -> DataFrame:
        """Percent of a group's principal at risk; groups without a loan at risk are absent, a total of 0 gives NULL."""
        zero = F.lit(0.0)
        sums = self._table("cells", selection).groupBy("region", "grade").agg(
            F.sum("risk_loans").alias("_rows"), F.coalesce(F.sum("principal_sum"), zero).alias("_total"), F.coalesce(F.sum("risk_principal_sum"), zero).alias("_part")
        )
        return sums.where("_rows > 0").select("region", "grade", (F.try_divide("_part", "_total") * 100.0).alias("prncp_per_risk"))

    def median_amount(self, selection: Selection | None = Selection()) -> DataFrame:
        """The exact median amount as number and as text.

        The counts per bin, 8,200 at most, tell which bin holds each of the middle ranks; only those bins are read.
        """
        bins = self._table("bins", selection).groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect()
        total = sum(r["n"] for r in bins)
        ranks, wanted, before = sorted({max(0, (total - 1) // 2), total // 2}), [], 0
        for r in bins:
            wanted += [(r["bin"], k, before) for k in ranks if before <= k < before + r["n"]]
            before += r["n"]
        values = None
        for b, rank, start in wanted:  # one or two
            rows = self._table("amounts", selection).where(F.col("bin") == b).groupBy("amount").agg(F.sum("n").alias("n"))
            upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("amount"))  # the values of one bin
            one = rows.withColumn("upto", upto).where((F.col("upto") > rank - start) & (F.col("upto") - F.col("n") <= rank - start)).select("amount")
            values = one if values is None else values.unionAll(one)
        if values is None:
            values = self.spark.createDataFrame([], "amount double")
        return values.agg(F.avg("amount").alias("median_amt")).select("median_amt", money("median_amt").alias("label"))

    def key_figures(self, selection: Selection | None = Selection()) -> DataFrame:
        """Number of loans, mean rate, mean term in years and median amount in one row."""
        sums = self._table("cells", selection).agg(
            F.coalesce(F.sum("loans"), F.lit(0)).alias("loans"),
            F.try_divide(F.sum("rate_sum"), F.sum("rate_n")).alias("avg_rate"),
            (F.try_divide(F.sum("months_sum"), F.sum("months_n")) / 12.0).alias("avg_years"),
        )
        return sums.withColumn("median_amt", self.median_amount(selection).select("median_amt").scalar())
