"""Monitoring points: one row per (series labels, timestamp) with a numeric value.

Points are stored as the monitoring API types them: byte counts as INT64, gauges as DOUBLE, either one
inside a typed value (`int64_value`, `double_value`, `distribution_value.count`). All become DOUBLE; a
whole number or decimal that DOUBLE cannot hold exactly is an error, never rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.schema import METRIC_POINTS
from costframe.sources.conform import conform, read_parquet

#: Fields of a typed value, in the order in which they are looked at (fixed by the API).
TYPED_VALUES = ("int64_value", "double_value", "distribution_value", "count")


def as_double(value: Column, kind: T.DataType) -> Column:
    """`value` as DOUBLE without loss."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.cast("double")
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        digits = "decimal(20,0)" if isinstance(kind, T.IntegralType) else kind.simpleString()
        double = value.cast("double")
        return F.when(value.isNull() | (double.cast(digits) == value.cast(digits)), double).otherwise(
            F.raise_error(F.concat(F.lit("metric value is not exact as DOUBLE: "), value.cast("string"))))
    if isinstance(kind, T.StructType):
        there = {f.name: f.dataType for f in kind.fields}
        parts = [as_double(value[n], there[n]) for n in TYPED_VALUES if n in there]
        if parts:
            return F.coalesce(*parts)
    raise TypeError(f"no number in a metric value of type {kind.simpleString()}")


def read_metric_points(spark: SparkSession, path: str) -> DataFrame:
    """Parquet points with any stored number type; absent label columns are NULL."""
    stored = read_parquet(spark, path)
    return conform(stored.withColumn("value", as_double(F.col("value"), stored.schema["value"].dataType)), METRIC_POINTS)
