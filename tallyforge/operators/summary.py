"""Bucketed group summary with error-bar bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.columns import bucket_half


def bucket_summary(df: DataFrame, group: str, bucket: str, measure: str) -> DataFrame:
    """Count, mean and sample sd of ``measure`` by group and 0.5-wide bucket, and mean -/+ sd.

    The sd of a single row is NULL, and so are its bounds.
    """
    stats = df.groupBy(group, bucket_half(bucket).alias(bucket)).agg(
        F.count(F.lit(1)).alias("count"), F.avg(measure).alias("mean"), F.stddev_samp(measure).alias("stdev")
    )
    return stats.withColumns({"lower": F.col("mean") - F.col("stdev"), "upper": F.col("mean") + F.col("stdev")})
