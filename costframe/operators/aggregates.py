"""Aggregations that need more than one level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def two_level_mean(df: DataFrame, series_keys: Sequence[str], group_keys: Sequence[str],
                   value: str = "value", out: str = "mean_value") -> DataFrame:
    """Mean per series, then mean of those means per group (not one flat average).

    Both levels are hash aggregates with map-side partial aggregation; the first level's output is
    one row per series and day, so the second shuffle is small.
    """
    per_series = df.groupBy(*series_keys).agg(F.avg(value).alias("_series_mean"))
    return per_series.groupBy(*group_keys).agg(F.avg("_series_mean").alias(out))
