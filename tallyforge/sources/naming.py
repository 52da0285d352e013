"""Column names made safe for SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def safe_name(name: str) -> str:
    """Lower case, with every run of other characters than letters and digits as one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def safe_columns(df: DataFrame) -> DataFrame:
    """The frame with safe column names; two names that become equal are an error."""
    names = [safe_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names are not distinct after normalising: {names}")
    return df.toDF(*names)
