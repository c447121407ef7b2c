"""Newline-delimited JSON day files, read with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """NDJSON load; dates/timestamps are parsed by the schema, unknown fields are ignored."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
