"""Materialise an intermediate result as a parquet table in the shared checkpoint folder.

Used where one aggregated result feeds several branches of a plan. Catalyst would push each
branch's filter below the shared aggregate (so no exchange is reused and the scan runs once per
branch). Writing it once and reading it back computes it once, cuts the lineage (a lost executor
re-runs only the small downstream stages), and keeps the columnar format for the readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from costframe.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
