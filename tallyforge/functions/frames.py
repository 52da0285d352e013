"""Small helpers over whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """The frame with the named columns rounded."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
