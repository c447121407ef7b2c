"""Scheduled daily reports: recompute one billing day and replace it in the report table.

A run for `run_date` reports on `run_date - 2 days` (exports arrive late). `run_late_days` also picks up
lines that arrive for older days: it reads the export partitions that changed since its last run, finds
the usage days they touch and recomputes exactly those, each from the partitions that hold it. Every run
is an overwrite by day, so re-running is safe and a day whose recomputation is empty is cleared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe.constants import REPORT_LAG_DAYS
from costframe.plans import compute, metrics, storage
from costframe.plans.common import days_filter, default_run_date
from costframe.sinks.files import write_ndjson_day
from costframe.sinks.tables import backfill_days, replace_day
from costframe.sources import export_index
from costframe.sources.billing import read_billing_export
from costframe.sources.ndjson import read_ndjson
from costframe.schema import NAT_REPORT

BILLING_REPORTS: dict[str, Callable[..., DataFrame]] = {
    "compute_instance": compute.compute_instance_cost,
    "load_balancer": compute.load_balancer_cost,
    "compute_others": compute.other_compute_cost,
    "storage_bucket": storage.storage_bucket_cost,
}


def run_billing_report(name: str, billing: DataFrame, table_path: str, run_date=None,
                       lag_days: int = REPORT_LAG_DAYS, pad_days: int | None = None,
                       exported_from_day: bool = True) -> str:
    """Recompute report `name` for the report day of `run_date` and replace that day.
    Returns the report day (ISO).

    A line is exported on its usage day or later, and the day's first instant in the billing zone
    lies on the same UTC date, so with `exported_from_day` older export partitions are not read
    while late lines, however late, are. Turn it off for lines that are billed ahead of use.
    Reports keep exact DECIMAL money.
    """
    day = default_run_date(run_date, lag_days)
    if exported_from_day:
        billing = billing.filter(F.col("partition_date") >= F.lit(day))
    report = BILLING_REPORTS[name](billing, target_date=day, pad_days=pad_days, money_as_double=False)
    replace_day(report, table_path, day)
    return day.isoformat()


def lines_of_days(spark: SparkSession, export_path: str, index: DataFrame, days) -> DataFrame:
    """Billing lines of the usage days, read from the export partitions that hold them by the index."""
    lines = read_billing_export(spark, export_path)
    return lines.filter(export_index.in_partitions(export_index.partitions_of(index, days))).filter(days_filter(days))


def rerun_days(spark: SparkSession, name: str, export_path: str, index_path: str, table_path: str, days) -> list[str]:
    """Recompute report `name` for any days, however old, reading only the export partitions that hold them.

    Partitions that the index does not have as they are now are scanned first, so no line is missed; the index
    itself is left to `run_late_days`.
    """
    change = export_index.changes(spark, export_path, index_path)
    known = export_index.read_index(spark, index_path)
    if change.partitions:
        known = known.filter(~F.col(export_index.PARTITION).isin(change.partitions))
    lines = lines_of_days(spark, export_path, known.unionByName(change.entries), days)
    backfill_days(BILLING_REPORTS[name](lines, money_as_double=False), table_path, days)
    return sorted(str(d) for d in days)


def run_late_days(spark: SparkSession, name: str, export_path: str, index_path: str, table_path: str, run_date=None,
                  lag_days: int = REPORT_LAG_DAYS) -> list[str]:
    """Recompute report `name` for every day, up to the report day of `run_date`, that changed export
    partitions touch, and replace those days. Returns them (ISO).

    The index at `index_path` belongs to this report table; the first run finds every partition new. A
    partition counts as read only when the table has its days and none of them is past the report
    day; otherwise the next run reads it again. So a run that fails anywhere is repeated whole.
    """
    last = default_run_date(run_date, lag_days)
    change = export_index.changes(spark, export_path, index_path)
    days = [d for d in change.days if d <= last]
    if days:
        known = export_index.read_index(spark, index_path)
        if change.partitions:
            known = known.filter(~F.col(export_index.PARTITION).isin(change.partitions))
        lines = lines_of_days(spark, export_path, known.unionByName(change.entries), days)
        backfill_days(BILLING_REPORTS[name](lines, money_as_double=False), table_path, days)
    ahead = {r[0] for r in change.entries.filter(F.col("usage_date") > F.lit(last)).select(export_index.PARTITION).distinct().collect()}
    export_index.commit(change, index_path, [p for p in change.partitions if p not in ahead])
    return [d.isoformat() for d in days]


def run_nat_report(points: DataFrame, sku_map: DataFrame, prices: DataFrame, day_files_root: str,
                   table_path: str, run_date=None, lag_days: int = REPORT_LAG_DAYS) -> str:
    """NAT day: traffic and fee -> NDJSON day file -> the day's table partition replaced by it."""
    day = default_run_date(run_date, lag_days)
    nat = metrics.nat_traffic(points, sku_map, prices, target_date=day)
    folder = write_ndjson_day(nat, day_files_root, day)
    loaded = read_ndjson(nat.sparkSession, folder, NAT_REPORT).withColumn("usage_date", F.lit(day))
    replace_day(loaded.select(*NAT_REPORT.fieldNames()), table_path, day)
    return day.isoformat()
