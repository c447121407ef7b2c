"""Which usage days the partitions of a stored export hold, and which partitions have changed.

An export delivers lines late: a partition of today can hold usage of any earlier day. The index has one
row per (export partition, usage day) with the mark of the partition's files when it was read. Two
questions follow from it without reading lines:

* a partition is new or changed where its files' mark differs from the index's, and only those are
  scanned (one column) to learn which usage days they touch;
* the partitions that hold a usage day are the only ones that a re-run of this day has to read, given
  to the scan as a partition filter.

Marks come from the file listing (names, sizes, times) by a scan that reads no file content, summed per
partition on the executors. The index is itself a table partitioned by export day, replaced partition by
partition with a commit record (`sinks.tables`), and has a few rows per export day, whatever the export's size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.constants import BILLING_TZ
from costframe.functions.time import la_date
from costframe.operators.materialize import materialize
from costframe.sinks.tables import backfill_days, hadoop_fs, recover
from costframe.sources.billing import read_billing_export

PARTITION = "partition_date"
INDEX = "mark string, usage_date date, n_lines long, partition_date date"


@dataclass(frozen=True)
class Changes:
    """Partitions whose files changed since the index was written, and the usage days they touch."""

    partitions: list[dt.date]  # with those that are gone
    days: list[dt.date]
    entries: DataFrame  # index rows of the partitions as they are now


def partition_marks(spark: SparkSession, export_path: str) -> DataFrame:
    """(partition_date, mark) from the listing of the export's files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(export_path)
    one = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime")
    return files.groupBy(F.col(PARTITION).cast("date").alias(PARTITION)).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.bit_xor(one)).alias("mark"))


def read_index(spark: SparkSession, index_path: str) -> DataFrame:
    """The index rows (none where there is no index yet)."""
    fs, p = hadoop_fs(spark, index_path)
    if not fs.exists(p):
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(index_path)


def changes(spark: SparkSession, export_path: str, index_path: str, tz: str = BILLING_TZ) -> Changes:
    """Compare the export's files with the index and scan the partitions that differ.

    A line that left a changed partition touches its day too: the days that the index had count as touched.
    """
    recover(spark, index_path)
    known = read_index(spark, index_path)
    now = partition_marks(spark, export_path).alias("now")
    old = known.groupBy(PARTITION).agg(F.first("mark").alias("mark")).alias("old")
    differ = now.join(old, F.col(f"now.{PARTITION}") == F.col(f"old.{PARTITION}"), "full_outer").where(
        ~F.col("now.mark").eqNullSafe(F.col("old.mark"))).select(F.coalesce(f"now.{PARTITION}", f"old.{PARTITION}").alias(PARTITION), F.col("now.mark"))
    rows = differ.collect()  # one row per export day
    partitions = sorted(r[PARTITION] for r in rows)
    there = F.create_map(*[F.lit(x) for r in rows if r["mark"] for x in (r[PARTITION].isoformat(), r["mark"])]) if any(r["mark"] for r in rows) else None
    if there is None:
        entries = spark.createDataFrame([], INDEX)
    else:
        lines = read_billing_export(spark, export_path).where(F.col(PARTITION).isin([r[PARTITION] for r in rows if r["mark"]]))
        counted = lines.groupBy(PARTITION, la_date("usage_start_time", tz).alias("usage_date")).agg(F.count(F.lit(1)).alias("n_lines"))
        entries = materialize(counted.select(there[F.col(PARTITION).cast("string")].alias("mark"), "usage_date", "n_lines", PARTITION), "export-index")
    touched = entries.select("usage_date").unionByName(known.where(F.col(PARTITION).isin(partitions)).select("usage_date")) if partitions else entries.select("usage_date")
    days = sorted(r[0] for r in touched.where("usage_date is not null").distinct().collect())
    return Changes(partitions, days, entries)


def commit(change: Changes, index_path: str, partitions: Iterable[dt.date]) -> None:
    """Record `partitions` of `change` as read."""
    if partitions := list(partitions):
        backfill_days(change.entries, index_path, partitions, partition_col=PARTITION, files_per_day=1)


def partitions_of(index: DataFrame, days: Iterable) -> list[dt.date]:
    """Export partitions that hold lines of any of the usage days."""
    wanted = [F.lit(str(d)).cast("date") for d in days]
    return sorted(r[0] for r in index.where(F.col("usage_date").isin(wanted)).select(PARTITION).distinct().collect())


def in_partitions(partitions: Iterable[dt.date]) -> Column:
    """Partition filter of the scan: only these export partitions."""
    wanted = [F.lit(p) for p in partitions]
    return F.col(PARTITION).isin(wanted) if wanted else F.lit(False)
