"""Billing export scans, the multi-account union and the time filters of spend questions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.constants import PARTITION_PAD_MONTHS
from costframe.schema import BILLING_COLUMNS, BILLING_EXPORT
from costframe.sources.conform import conform, read_parquet


def read_billing_export(spark: SparkSession, path: str) -> DataFrame:
    """Parquet billing export, partitioned by `partition_date` (partition discovery on).

    Columns are taken by name with the types the files have (money may be DOUBLE, NUMERIC or any
    DECIMAL) and cast once to the export schema; money becomes DECIMAL(28,12), instants their UTC
    wall clock.
    """
    return conform(read_parquet(spark, path), BILLING_EXPORT)


def union_accounts(tables: Sequence[DataFrame], keep_partition: bool = True) -> DataFrame:
    """UNION ALL of several account tables with the same export schema, columns listed by name.

    Filters applied to the result are pushed by Catalyst into every branch's scan
    (partition filters included), so each branch is pruned on its own.
    """
    if not tables:
        raise ValueError("at least one billing table is needed")
    cols = list(BILLING_COLUMNS) + (["partition_date"] if keep_partition else [])
    return reduce(DataFrame.unionByName, [t.select(*cols) for t in tables])


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def padded_partition_filter(start, end, months: int = PARTITION_PAD_MONTHS,
                            column: str = "partition_date") -> Column:
    """`partition_date BETWEEN start - months AND end + months` (late exports stay in range)."""
    s, e = _as_date(start), _as_date(end)
    return F.col(column).between(F.add_months(F.lit(s), -months), F.add_months(F.lit(e), months))


def invoice_month_filter(first: str, last: str | None = None) -> Column:
    """Invoice month (`YYYYMM` string) equal to `first`, or within [first, last]."""
    for m in (first, last):
        if m is not None and (len(m) != 6 or not m.isdigit()):
            raise ValueError(f"invoice month must be YYYYMM, got {m!r}")
    if last is None:
        return F.col("invoice.month") == F.lit(first)
    return F.col("invoice.month").between(F.lit(first), F.lit(last))


def month_bounds(month: str) -> tuple[dt.date, dt.date]:
    """First and last calendar day of a `YYYYMM` month."""
    y, m = int(month[:4]), int(month[4:])
    first = dt.date(y, m, 1)
    nxt = dt.date(y + (m == 12), m % 12 + 1, 1)
    return first, nxt - dt.timedelta(days=1)
