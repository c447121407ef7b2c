"""Line-level summaries that expose single operators (net cost, label tests, categories)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.constants import COMPUTE_SERVICE_ID, STORAGE_SERVICE_ID
from costframe.functions.categories import compute_category, storage_category
from costframe.functions.costs import net_cost
from costframe.functions.time import days_in_month, la_date
from costframe.plans.common import money_to_double


def net_cost_lines(billing: DataFrame) -> DataFrame:
    """Every line with its cost and its cost after credits."""
    return money_to_double(billing.select(
        "billing_account_id", F.col("service.id").alias("service_id"), F.col("sku.id").alias("sku_id"),
        "usage_start_time", "cost", net_cost().alias("net_cost")))


def summarize(lines: DataFrame, *keys: Column) -> DataFrame:
    """Line count, raw cost and net cost per key."""
    return money_to_double(lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("cost").alias("cost"),
        F.sum(net_cost()).alias("net_cost")))


def compute_category_counts(billing: DataFrame) -> DataFrame:
    lines = billing.filter(F.col("service.id") == COMPUTE_SERVICE_ID)
    return summarize(lines, compute_category().alias("sku_category"))


def storage_category_counts(billing: DataFrame) -> DataFrame:
    lines = billing.filter(F.col("service.id") == STORAGE_SERVICE_ID)
    return summarize(lines, storage_category().alias("sku_category"))


def usage_month_scaled(billing: DataFrame) -> DataFrame:
    """Storage usage times the number of days in the usage month, per usage day."""
    day = la_date("usage_start_time")
    lines = billing.filter(F.col("service.id") == STORAGE_SERVICE_ID)
    return money_to_double(lines.groupBy(day.alias("usage_date")).agg(
        F.sum(F.col("usage.amount_in_pricing_units") * days_in_month(day)).alias("total_usage")))
