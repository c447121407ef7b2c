"""Monitoring-point reports: NAT traffic fee (R5) and bucket object count.

The monitoring API's per-series daily alignment plus cross-series reducer become hash aggregates
over a points table: NAT is a sum of sums (one aggregate), object count a mean of per-series means
(two aggregates). Received and sent bytes come out of ONE aggregate with conditional sums, so a
series that only sent (or only received) keeps 0 on the other side, and the project is part of
the key (series from different projects never overwrite each other).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.constants import (BILLING_TZ, BYTES_PER_GIB, GCE_INSTANCE, GCS_BUCKET, NAT_RECEIVED_METRIC,
                                 NAT_SENT_METRIC, NAT_SERIES_LABELS, OBJECT_COUNT_GROUP, OBJECT_COUNT_METRIC)
from costframe.functions.time import la_date
from costframe.operators.aggregates import two_level_mean
from costframe.operators.joins import broadcast_dimension
from costframe.plans.common import local_day_filter
from costframe.schema import METRIC_LABELS


def _days(points: DataFrame, target_date, date_range, tz: str) -> DataFrame:
    if target_date is not None:
        date_range = (target_date, target_date)
    if date_range is None:
        return points
    return points.filter(local_day_filter(date_range[0], date_range[1], ts="ts", tz=tz))


def nat_traffic(points: DataFrame, sku_map: DataFrame, prices: DataFrame, target_date=None,
                date_range=None, tz: str = BILLING_TZ, projects=None) -> DataFrame:
    """NAT GiB received / sent per (project, gateway, region, psm, instance, inner ip, day) and
    the fee = account price of the region's NAT SKU x (received + sent). No SKU or price: NULL fee.
    `projects` optionally restricts the monitored projects."""
    pts = points.filter(F.col("metric").isin(NAT_RECEIVED_METRIC, NAT_SENT_METRIC)
                        & (F.col("resource_type") == GCE_INSTANCE))
    if projects is not None:
        pts = pts.filter(F.col("project_id").isin(list(projects)))
    pts = _days(pts, target_date, date_range, tz)
    day = la_date("ts", tz).alias("usage_date")
    agg = pts.groupBy(*NAT_SERIES_LABELS, day).agg(
        F.sum(F.when(F.col("metric") == NAT_RECEIVED_METRIC, F.col("value"))).alias("_rx"),
        F.sum(F.when(F.col("metric") == NAT_SENT_METRIC, F.col("value"))).alias("_tx"))
    gib = F.lit(float(BYTES_PER_GIB))
    agg = agg.select(*NAT_SERIES_LABELS, "usage_date",
                     (F.coalesce("_rx", F.lit(0.0)) / gib).alias("received_bytes_count"),
                     (F.coalesce("_tx", F.lit(0.0)) / gib).alias("sent_bytes_count"))
    nat = (sku_map.filter((F.col("kind") == "nat") & (F.col("component") == "nat-data"))
           .select("region", "sku_id")
           .join(prices.select("sku_id", F.col("account_price").cast("double").alias("_price")), "sku_id", "left")
           .select("region", "_price"))
    out = agg.join(broadcast_dimension(nat, "nat-price"), "region", "left")
    return out.select(*NAT_SERIES_LABELS, "usage_date", "received_bytes_count", "sent_bytes_count",
                      (F.col("_price") * (F.col("received_bytes_count") + F.col("sent_bytes_count")))
                      .alias("nat_fee_usd"))


def object_count(points: DataFrame, target_date=None, date_range=None, tz: str = BILLING_TZ,
                 digits: int | None = None, project: str | None = None,
                 bucket_name: str | None = None) -> DataFrame:
    """Daily mean object count per (project, bucket, region, storage class): the mean per
    series (all labels) and day first, then the mean of those means. `project` / `bucket_name`
    optionally narrow the series (the bucket is matched on its label)."""
    pts = points.filter((F.col("metric") == OBJECT_COUNT_METRIC) & (F.col("resource_type") == GCS_BUCKET))
    if project is not None:
        pts = pts.filter(F.col("project_id") == project)
    if bucket_name is not None:
        pts = pts.filter(F.col("bucket_name") == bucket_name)
    pts = _days(pts, target_date, date_range, tz).withColumn("usage_date", la_date("ts", tz))
    out = two_level_mean(pts, list(METRIC_LABELS) + ["usage_date"], list(OBJECT_COUNT_GROUP) + ["usage_date"],
                         value="value", out="object_count")
    if digits is not None:
        out = out.withColumn("object_count", F.round("object_count", digits))
    return out
