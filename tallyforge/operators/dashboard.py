"""Charts, key figures and detail table of the loan dashboard, as frames."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyforge.functions.columns import millions, not_in_keep_null, parse_rate, sum_or_zero, term_to_months, to_numeric
from tallyforge.functions.text import money, short_number, with_unit
from tallyforge.operators.filters import limit_flagged
from tallyforge.operators.order_stats import exact_median
from tallyforge.sources.lookups import SETTLED_STATUSES

GROUP = ("region", "grade")


def principal(base: DataFrame) -> DataFrame:
    """Outstanding principal by region and grade; NULL for a group without any value (SQL rule)."""
    return base.groupBy(*GROUP).agg(F.sum("out_prncp").alias("out_prncp"))


def principal_chart(base: DataFrame) -> DataFrame:
    """The chart frame: a group without values counts 0, also given in millions."""
    total = sum_or_zero(F.col("out_prncp"))
    return base.groupBy(*GROUP).agg(total.alias("out_prncp"), millions(total).alias("out_prncp_m"))


def risk_share(base: DataFrame) -> DataFrame:
    """Percent of a group's principal whose loans are neither current, paid nor charged off.

    A NULL status is at risk. Groups without a loan at risk are absent; a total of 0 gives NULL.
    Total and part come from one conditional aggregation, so neither a join nor a window is needed.
    """
    at_risk = not_in_keep_null("loan_status", SETTLED_STATUSES)
    return (
        base.groupBy(*GROUP)
        .agg(
            sum_or_zero(F.col("out_prncp")).alias("_total"),
            sum_or_zero(F.when(at_risk, F.col("out_prncp"))).alias("_part"),
            F.count_if(at_risk).alias("_rows"),
        )
        .where(F.col("_rows") > 0)
        .select(*GROUP, (F.try_divide("_part", "_total") * 100.0).alias("prncp_per_risk"))
    )


def avg_rate(base: DataFrame) -> DataFrame:
    """Mean rate as number and as text such as ``"14.9 %"``."""
    mean = base.agg(F.avg(parse_rate("int_rate")).alias("avg_rate"))
    return mean.select("avg_rate", with_unit(short_number("avg_rate"), "%").alias("label"))


def median_amount(base: DataFrame) -> DataFrame:
    """Exact median amount as number and as text such as ``"$251,400"``."""
    amounts = base.select(to_numeric("loan_amnt").alias("loan_amnt"))
    return exact_median(amounts, "loan_amnt", "median_amt").select("median_amt", money("median_amt").alias("label"))


def avg_tenor(base: DataFrame) -> DataFrame:
    """Mean term in years; rows with another term than 36 or 60 months do not count."""
    mean = base.agg((F.avg(term_to_months("term")) / 12.0).alias("avg_years"))
    return mean.select("avg_years", with_unit(short_number("avg_years"), "years").alias("label"))


def key_figures(base: DataFrame) -> DataFrame:
    """All three key figures and the row count in one row; the means and the count share one pass."""
    row = base.agg(
        F.count(F.lit(1)).alias("loans"),
        F.avg(parse_rate("int_rate")).alias("avg_rate"),
        (F.avg(term_to_months("term")) / 12.0).alias("avg_years"),
    )
    return row.withColumn("median_amt", median_amount(base).select("median_amt").scalar())


@contextmanager
def shared(base: DataFrame) -> Iterator[DataFrame]:
    """Keep the filtered loans for the reports of one refresh, then let go of them."""
    kept = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


#: Display names of the detail columns, in order (fixed values).
DETAIL_NAMES = {
    "region": "Region",
    "office_no": "Office",
    "grade": "Grade",
    "sub_grade": "Sub Grade",
    "loan_amnt": "Loan Amt",
    "term": "Term",
    "int_rate": "Rate",
    "emp_title": "Emp Title",
    "emp_length": "Emp Length",
    "annual_inc": "Ann Income",
    "loan_status": "Status",
    "title": "Purpose",
    "addr_state": "State",
    "out_prncp": "Principal",
}


def detail_rows(base: DataFrame) -> DataFrame:
    """Detail columns under their display names, amounts as numbers."""
    numeric = base.withColumns({c: to_numeric(c) for c in ("loan_amnt", "annual_inc")})
    return numeric.select("member_id", *DETAIL_NAMES).withColumnsRenamed(DETAIL_NAMES)


def detail_table(base: DataFrame, n: int = 1000) -> DataFrame:
    """The first ``n`` detail rows by member and whether there are more."""
    return limit_flagged(detail_rows(base), "member_id", n)
