"""Report tables partitioned by `usage_date`, rewritten a day at a time.

New rows are first written whole to a staging folder inside the table (hidden from readers by its
name). When that job has committed, a commit record names the staged folder, the days that it replaces
and the days that end without rows; then each day's folder is deleted and the staged one renamed into
its place, and the record goes. So a failed job leaves the table as it was, a reader can miss a day
only between those two steps, and a failure between them is made good by the next run: every writer
first replays the records it finds (each step is skipped where it is done) and then removes staging
folders that no record names. A table has one writer at a time. Re-running a day gives the same table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAGING, COMMIT = "_staging-", "_commit-"


def _day_str(d) -> str:
    return (d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))).isoformat()


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, p = hadoop_fs(spark, path)
    _, part = hadoop_fs(spark, path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):
        raise RuntimeError(f"could not write {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, new: str, target: str) -> None:
    """The folder `new` in place of `target`; nothing to do where `new` is gone (it is in place)."""
    fs, new_path = hadoop_fs(spark, new)
    _, target_path = hadoop_fs(spark, target)
    if fs.exists(new_path):
        fs.delete(target_path, True)
        if not fs.rename(new_path, target_path):
            raise RuntimeError(f"could not put {new} in place")


def _apply(spark: SparkSession, path: str, name: str) -> None:
    """Do, or finish, the swap that a commit record describes."""
    record = json.loads(_read_text(spark, f"{path}/{name}"))
    col = record["partition_col"]
    for d in record["replaced"]:
        _put(spark, f"{path}/{record['staged']}/{col}={d}", f"{path}/{col}={d}")
    fs, _ = hadoop_fs(spark, path)
    for gone in [f"{path}/{col}={d}" for d in record["removed"]] + [f"{path}/{record['staged']}", f"{path}/{name}"]:
        fs.delete(hadoop_fs(spark, gone)[1], True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish swaps that were cut short, and remove what jobs without a commit record left."""
    names = _names(spark, path)
    for name in names:
        if name.startswith(COMMIT) and name.endswith(".json"):
            _apply(spark, path, name)
    fs, _ = hadoop_fs(spark, path)
    for name in names:
        if name.startswith((STAGING, COMMIT)):
            fs.delete(hadoop_fs(spark, f"{path}/{name}")[1], True)


def _swap_days(spark: SparkSession, staged: str, path: str, days: Iterable[str], partition_col: str) -> None:
    """Put the staged folder of each day in place of the table's; days without one are removed."""
    there = set(_names(spark, f"{path}/{staged}"))
    days = list(days)
    record = {"staged": staged, "partition_col": partition_col,
              "replaced": [d for d in days if f"{partition_col}={d}" in there], "removed": [d for d in days if f"{partition_col}={d}" not in there]}
    name = f"{COMMIT}{staged.removeprefix(STAGING)}.json"
    _write_text(spark, f"{path}/{name}", json.dumps(record))
    _apply(spark, path, name)


def replace_day(df: DataFrame, path: str, day, partition_col: str = "usage_date",
                fmt: str = "parquet") -> None:
    """Delete-then-insert of one day: `INSERT OVERWRITE t PARTITION (usage_date = day) SELECT ...`.

    Rows of `df` for other days are not written (the filter keeps the overwrite to one day). A day
    without rows keeps a folder with an empty file, so the table can still be read without a schema.
    """
    spark, d = df.sparkSession, _day_str(day)
    recover(spark, path)
    staged = f"{STAGING}{uuid.uuid4().hex[:12]}"
    rows = df.filter(F.col(partition_col) == F.lit(d).cast("date")).drop(partition_col)
    rows.write.format(fmt).save(f"{path}/{staged}/{partition_col}={d}")
    _swap_days(spark, staged, path, [d], partition_col)


FILES_PER_DAY = 4


def backfill_days(df: DataFrame, path: str, days: Iterable, partition_col: str = "usage_date",
                  fmt: str = "parquet", files_per_day: int = FILES_PER_DAY) -> None:
    """Rewrite many days in one job; listed days without rows are removed (so they read as empty).

    The plan runs once: rows are dealt by day and a hash of the row, so a large day is written by
    `files_per_day` tasks, and the days that have rows are seen from the folders written.
    """
    wanted = sorted({_day_str(d) for d in days})
    recover(df.sparkSession, path)
    rows = df.filter(F.col(partition_col).isin([F.lit(d).cast("date") for d in wanted]))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(files_per_day))
    staged = f"{STAGING}{uuid.uuid4().hex[:12]}"
    rows.repartition(F.col(partition_col), part).write.partitionBy(partition_col).format(fmt).save(f"{path}/{staged}")
    _swap_days(df.sparkSession, staged, path, wanted, partition_col)


def read_report_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
