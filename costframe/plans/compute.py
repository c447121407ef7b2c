"""Compute reports: instance cost pivot (R1), load balancer cost (R2), unlabelled residual.

Each is one scan, per-row expressions (no explode), and one hash aggregate with map-side partial
aggregation: a bill line never leaves its partition before being pre-summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.constants import (COMPUTE_CATEGORIES, COMPUTE_SERVICE_ID, LABEL_FORWARDING_RULE,
                                 LABEL_INNER_IP, LABEL_INSTANCE_NAME, LABEL_PSM, TEXT_DEFAULT)
from costframe.functions.categories import compute_category, is_residual_compute
from costframe.functions.costs import net_cost
from costframe.functions.labels import has_label, label_value, lacks_label, no_labels
from costframe.functions.time import la_date
from costframe.operators.pivot import fixed_pivot_sum, row_total
from costframe.plans.common import apply_day_filters, money_to_double
from costframe.schema import MONEY


def _base(billing: DataFrame, target_date, date_range, pad_days) -> DataFrame:
    lines = billing.filter(F.col("service.id") == COMPUTE_SERVICE_ID)
    return apply_day_filters(lines, target_date, date_range, pad_days)


def compute_instance_cost(billing: DataFrame, target_date=None, date_range=None, pad_days=None,
                          money_as_double: bool = True) -> DataFrame:
    """Cost per (account, invoice month, day, project, instance, psm, inner ip), pivoted over
    the eight compute categories, with a subtotal. Lines with a forwarding-rule label are left
    to R2; a NULL label key in the array drops the line (NOT IN semantics)."""
    lines = _base(billing, target_date, date_range, pad_days).filter(lacks_label(LABEL_FORWARDING_RULE))
    sel = lines.select(
        F.col("billing_account_id").alias("billing_name"),
        F.col("invoice.month").alias("invoice_month"),
        la_date("usage_start_time").alias("usage_date"),
        F.col("project.id").alias("project_id"),
        net_cost().alias("total_cost"),
        label_value(LABEL_INSTANCE_NAME).alias("instance_name"),
        label_value(LABEL_PSM).alias("psm"),
        label_value(LABEL_INNER_IP).alias("inner_ip"),
        compute_category().alias("sku_category"),
    )
    keys = ["billing_name", "invoice_month", "usage_date", "project_id", "instance_name", "psm", "inner_ip"]
    agg = sel.groupBy(*keys).agg(*fixed_pivot_sum("sku_category", "total_cost", COMPUTE_CATEGORIES))
    zero = F.lit(0).cast(MONEY)
    out = agg.select(
        "billing_name", "invoice_month", "usage_date", "project_id",
        F.coalesce("instance_name", F.lit(TEXT_DEFAULT)).alias("instance_name"),
        F.coalesce("psm", F.lit(TEXT_DEFAULT)).alias("psm"),
        "inner_ip",
        row_total(COMPUTE_CATEGORIES, zero).cast("decimal(38,12)").alias("SUBTOTAL"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in COMPUTE_CATEGORIES],
    )
    return money_to_double(out) if money_as_double else out


def load_balancer_cost(billing: DataFrame, target_date=None, date_range=None, pad_days=None,
                       money_as_double: bool = True) -> DataFrame:
    """R2: cost of lines carrying a forwarding-rule label, per rule."""
    lines = _base(billing, target_date, date_range, pad_days).filter(has_label(LABEL_FORWARDING_RULE))
    sel = lines.select(
        F.col("billing_account_id").alias("billing_name"),
        F.col("invoice.month").alias("invoice_month"),
        la_date("usage_start_time").alias("usage_date"),
        F.col("project.id").alias("project_id"),
        net_cost().alias("total_cost"),
        label_value(LABEL_FORWARDING_RULE).alias("forwarding_rule_name"),
    )
    # Grouped on the raw label value: NULL and a literal '--' stay two rows after the default.
    agg = sel.groupBy("billing_name", "invoice_month", "usage_date", "project_id", "forwarding_rule_name") \
        .agg(F.sum("total_cost").alias("SUBTOTAL_USD"))
    out = agg.select("billing_name", "invoice_month", "usage_date", "project_id",
                     F.coalesce("forwarding_rule_name", F.lit(TEXT_DEFAULT)).alias("forwarding_rule_name"),
                     "SUBTOTAL_USD")
    return money_to_double(out) if money_as_double else out


def other_compute_cost(billing: DataFrame, target_date=None, date_range=None, pad_days=None,
                       money_as_double: bool = True) -> DataFrame:
    """Compute lines with no labels at all and no category word, per description."""
    lines = (_base(billing, target_date, date_range, pad_days)
             .filter(is_residual_compute("sku.description"))
             .filter(no_labels()))
    sel = lines.select(
        F.col("sku.description").alias("description"),
        F.col("billing_account_id").alias("billing_name"),
        F.col("project.name").alias("project_name"),
        F.col("invoice.month").alias("invoice_month"),
        la_date("usage_start_time").alias("usage_date"),
        net_cost().alias("total_cost"),
    )
    out = sel.groupBy("description", "billing_name", "project_name", "invoice_month", "usage_date") \
        .agg(F.sum("total_cost").alias("SUBTOTAL"))
    return money_to_double(out) if money_as_double else out
