"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.operators.materialize import materialize

#: ASCII letters (fixed values).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str):
    """A column by its literal name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text):
    """A-Z in lower case, every other character unchanged.

    `lower` changes other alphabets too, so it serves only texts that are wholly ASCII.
    """
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of stages whose results are written.

    The cleaner follows the driver's garbage collection, which by itself may come much later than the disk
    is needed; nothing that a plan still refers to is removed.
    """
    spark.sparkContext._jvm.System.gc()


__all__ = ["LOWER", "UPPER", "col", "documents", "free_name", "lower_ascii", "materialize", "release_shuffles"]
