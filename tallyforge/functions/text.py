"""Number-to-text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import ColumnOrName, col


def short_number(value: ColumnOrName, digits: int = 2) -> Column:
    """Half-even rounding, printed without trailing zeros: 14.90 as ``14.9``, 15.00 as ``15``."""
    fixed = F.format_string(f"%.{digits}f", F.bround(col(value), digits))
    return F.when(col(value).isNotNull(), F.regexp_replace(fixed, r"\.?0+$", "") if digits else fixed)


def money(value: ColumnOrName) -> Column:
    """``$251,400``: half-even rounding to whole units with thousands separators."""
    return F.concat(F.lit("$"), F.format_number(F.bround(col(value), 0), 0))


def with_unit(text: Column, unit: str) -> Column:
    return F.concat(text, F.lit(f" {unit}"))


def json_row(*cols: str) -> Column:
    """The named columns of a row as one JSON object, NULL ones too."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def join_rows(df: DataFrame, key: str, value: str, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Values of a short frame as one text per group, ``", "`` between them, in key order.

    Meant for reports of a few rows (the result is one cell); put a row slice in front of it.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key), F.col(value).cast("string").alias("v"))))
    return df.groupBy(*by).agg(F.concat_ws(", ", F.transform(pairs, lambda p: p["v"])).alias(name))
