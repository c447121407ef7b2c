"""File sinks: NDJSON day files, JSON row export, CSV, SKU map by kind."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.schema import SKU_MAP
from costframe.sinks.tables import hadoop_fs


def write_ndjson_days(df: DataFrame, root: str, partition_col: str = "usage_date") -> None:
    """One NDJSON folder per day (`root/usage_date=YYYY-MM-DD/part-*.json`); days present in `df`
    are replaced, other days are kept (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("dateFormat", "yyyy-MM-dd").partitionBy(partition_col).json(root))


def write_ndjson_day(df: DataFrame, root: str, day, partition_col: str = "usage_date") -> str:
    """One day's NDJSON folder, replaced whole by the rows of `df` for `day`; without rows it is left
    empty, so a load of the folder clears the day. Returns the folder."""
    folder = f"{root}/{partition_col}={day}"
    rows = df.filter(F.col(partition_col) == F.lit(str(day)).cast("date")).drop(partition_col)
    rows.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(folder)
    return folder


def rows_to_json(df: DataFrame, order_by: Sequence[Column], n: int | None) -> DataFrame:
    """First `n` rows (in `order_by` order; None: all rows) as one JSON object each: decimals as
    strings, dates ISO, NULL fields kept. Returns a one-column DataFrame (`json`)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    top = display_rows(df, order_by, n)
    return top.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


def display_rows(df: DataFrame, order_by: Sequence[Column], n: int | None) -> DataFrame:
    """The rows shown in an answer: the first `n` after ordering (None: all rows)."""
    ordered = df.orderBy(*order_by)
    return ordered if n is None else ordered.limit(n)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


def write_sku_map(sku_map: DataFrame, path: str) -> None:
    """SKU map written out with one folder per component kind (cpu, ram, gpu, disk, nat)."""
    sku_map.write.mode("overwrite").partitionBy("kind").parquet(path)


def read_sku_map(spark: SparkSession, path: str) -> DataFrame:
    """A saved SKU map; estimates and price reports load it instead of deriving it again."""
    return spark.read.schema(SKU_MAP).parquet(path).select(*SKU_MAP.fieldNames())


def _folders(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the folders `key=value` in `path`."""
    fs, p = hadoop_fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n.removeprefix(f"{key}=") for n in names if n.startswith(f"{key}="))


def write_sku_map_version(sku_map: DataFrame, root: str, snapshot_date, keep: int = 2) -> str:
    """The SKU map of one price snapshot as a new version beside the older ones; returns its folder.

    The version is written to a staging folder and renamed when whole, so readers always find a map, and
    a rewrite of a snapshot's map is a higher version of it, not a replacement. The newest `keep` versions
    of the snapshot stay, so a reader that has begun on the one before can end.
    """
    spark = sku_map.sparkSession
    day = dt.date.fromisoformat(str(snapshot_date)).isoformat()
    folder = f"{root}/snapshot_date={day}"
    staged = f"{folder}/_staging-{uuid.uuid4().hex[:12]}"
    write_sku_map(sku_map, staged)
    fs, staged_path = hadoop_fs(spark, staged)
    versions = _folders(spark, folder, "version")
    version = f"{int(versions[-1]) + 1 if versions else 1:06d}"
    target = f"{folder}/version={version}"
    if not fs.rename(staged_path, hadoop_fs(spark, target)[1]):
        raise RuntimeError(f"could not put {target} in place")
    for old in [*versions, version][:-keep]:
        fs.delete(hadoop_fs(spark, f"{folder}/version={old}")[1], True)
    return target


def read_sku_map_version(spark: SparkSession, root: str, snapshot_date) -> DataFrame:
    """The saved SKU map that goes with the prices of `snapshot_date`: the highest version of the newest
    snapshot that is not later. An estimate so never mixes prices with a map that was made after them."""
    day = dt.date.fromisoformat(str(snapshot_date)).isoformat()
    fitting = [d for d in _folders(spark, root, "snapshot_date") if d <= day]
    for d in reversed(fitting):
        if versions := _folders(spark, f"{root}/snapshot_date={d}", "version"):
            return read_sku_map(spark, f"{root}/snapshot_date={d}/version={versions[-1]}")
    raise FileNotFoundError(f"no SKU map of {day} or earlier in {root}")
