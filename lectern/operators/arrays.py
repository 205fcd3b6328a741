"""Whole-array figures of rows that carry samples (pixels of a region, levels of a clip), and pairs of them by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean(c: Column) -> Column:
    total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.try_divide(total, F.size(c))


def share_over(c: Column, threshold: float) -> Column:
    return F.try_divide(F.size(F.filter(c, lambda x: x > threshold)).cast("double"), F.size(c))


def solid(c: Column, tolerance: float = 0.0) -> Column:
    """Whether all samples are about the same; an empty array is solid."""
    return F.coalesce(F.array_max(c) - F.array_min(c) <= tolerance, F.lit(True))


def paired(a: DataFrame, b: DataFrame, keys: list[str], samples: str) -> DataFrame:
    """Rows that both sides have at a position, with the mean and the greatest absolute difference of their samples, as far
    as both go; a position of one side alone is left out."""
    rows = a.select(*keys, F.col(samples).alias("_a")).join(b.select(*keys, F.col(samples).alias("_b")), keys)
    both = F.zip_with("_a", "_b", lambda x, y: F.abs(x - y))
    rows = rows.withColumn("_d", F.filter(both, lambda x: x.isNotNull()))
    return rows.select(*keys, mean(F.col("_d")).alias("mean_difference"), F.array_max("_d").alias("most_difference"))
