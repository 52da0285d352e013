"""Row filters, the multi-select of the dashboard and its choice lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import derive_office, derive_region, region_prefixes, to_numeric
from tallyforge.operators.joins import checked_broadcast, semi_lookup
from tallyforge.sources.lookups import PURPOSES, SUB_GRADES

#: Columns of the loan table that the dashboard shows.
LOAN_COLUMNS = (
    "member_id", "region", "grade", "sub_grade", "loan_amnt", "funded_amnt", "term", "int_rate", "emp_title",
    "emp_length", "annual_inc", "loan_status", "purpose", "title", "zip_code", "addr_state", "dti", "out_prncp",
)


class NoDataError(ValueError):
    """Raised when a selection leaves no row."""


@dataclass(frozen=True)
class Selection:
    """Chosen values per filter; an empty filter stands for all listed values."""

    regions: tuple[str, ...] = ()
    zip_codes: tuple[str, ...] = ()
    purposes: tuple[str, ...] = ()
    sub_grades: tuple[str, ...] = ()


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    for name in cols:
        df = df.where(F.col(name).isNotNull())
    return df


def drop_na(df: DataFrame, *cols: str) -> DataFrame:
    """Rows without a NULL in the named columns (all columns if none is named)."""
    return df.dropna(subset=list(cols) or None)


def loan_base(loans: DataFrame) -> DataFrame:
    """The shared base of all loan reports: known state and region, office, numeric principal."""
    return (
        filter_not_null(loans, "addr_state")
        .withColumn("region", derive_region("zip_code"))
        .where(F.col("region").isNotNull())
        .select(*LOAN_COLUMNS)
        .withColumns({"office_no": derive_office("zip_code"), "out_prncp": to_numeric("out_prncp")})
    )


def filter_multiselect(loans: DataFrame, offices: DataFrame, selection: Selection = Selection()) -> DataFrame:
    """:func:`loan_base` restricted to the selection.

    With nothing chosen a filter still keeps only listed values, so rows with an unlisted purpose,
    sub-grade or zip are dropped. Short lists become IN sets; the long zip list is a semi-join, which
    cannot multiply rows. A region choice is tested as zip prefixes, which the scan can use; without one,
    the four listed regions are all that :func:`loan_base` lets through.
    """
    picked = loans.where(
        F.col("purpose").isin(*(selection.purposes or PURPOSES))
        & F.col("sub_grade").isin(*(selection.sub_grades or SUB_GRADES))
    )
    if selection.regions:
        picked = picked.where(region_prefixes("zip_code", selection.regions))
    if selection.zip_codes:
        picked = picked.where(F.col("zip_code").isin(*selection.zip_codes))
    else:
        picked = semi_lookup(picked, offices, "zip_code")
    return loan_base(picked)


def guard_nonempty(df: DataFrame) -> DataFrame:
    """The frame itself, or :class:`NoDataError` when it has no row."""
    if df.isEmpty():
        raise NoDataError("No data available")
    return df


def row_slice(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def preview(df: DataFrame, n: int = 6) -> DataFrame:
    """Some ``n`` rows, as a quick look."""
    return df.limit(n)


def choices_cascade(offices: DataFrame, regions: tuple[str, ...] = ()) -> DataFrame:
    """Office choices of the chosen regions (all if none), by the region stated in the lookup."""
    rows = offices.where(F.col("region").isin(*regions)) if regions else offices
    return rows.select(F.col("office_no").alias("label"), F.col("zip_code").alias("value")).distinct()


def choices_labels(lookup: DataFrame, present_in: DataFrame | None = None) -> DataFrame:
    """Label and value of every purpose; with ``present_in``, only purposes that occur there."""
    if present_in is not None:
        used = checked_broadcast(present_in.select("purpose").distinct())
        lookup = lookup.join(used, "purpose", "left_semi")
    return drop_na(lookup, "purpose", "title").select(F.col("title").alias("label"), F.col("purpose").alias("value"))


def filter_metric(rows: DataFrame, column: str, value: str) -> DataFrame:
    """Keep the rows of one estimator or metric name."""
    return rows.where(F.col(column) == F.lit(value))


def limit_flagged(df: DataFrame, order: str | Column, n: int = 1000) -> DataFrame:
    """The first ``n`` rows by ``order`` and a ``truncated`` flag that is true only if more exist."""
    more = df.select(F.lit(1).alias("one")).limit(n + 1).agg((F.count("*") > n).alias("more")).scalar()
    return df.orderBy(order).limit(n).withColumn("truncated", more)
