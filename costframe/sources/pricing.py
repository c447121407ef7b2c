"""Price catalogue snapshots (one full snapshot per `partition_date`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.schema import PRICING_EXPORT
from costframe.sources.conform import conform, read_parquet


def read_pricing_export(spark: SparkSession, path: str) -> DataFrame:
    """Parquet price snapshots, any stored money type (see `conform`)."""
    return conform(read_parquet(spark, path), PRICING_EXPORT)


def newest_snapshot_date(pricing: DataFrame):
    """The export day of the newest price snapshot (None without one); reads the partition column only."""
    return pricing.agg(F.max("partition_date")).first()[0]


def latest_snapshot(pricing: DataFrame) -> DataFrame:
    """Rows of the newest snapshot: `partition_date = (SELECT max(partition_date) ...)`.

    The scalar subquery reads only the partition column; on a partitioned table Spark turns the
    equality into a runtime partition filter, so older snapshots are never read.
    """
    newest = pricing.select(F.max("partition_date")).scalar()
    return pricing.filter(F.col("partition_date") == newest)
