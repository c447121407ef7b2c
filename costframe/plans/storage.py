"""Storage bucket cost report.

Plan: one scan of storage lines -> ONE aggregate to (account, month, day, project, region,
bucket, raw description) -> category and sanitised SKU name per group (the regex runs per group,
not per line) -> one exchange of these pre-summed rows on the join keys, in whose partitions they
are summed by SKU name and folded into one row per join key: the spine's accounts, the storage,
class A and class B rows as short lists (at most accounts x distinct SKU names), and the network
pivot as conditional sums. Exploding the lists gives what joining the branches would; there is no
join, no second scan and no intermediate table.

Kept on purpose (documented quirks): the joins do not use the billing account (accounts sharing a
bucket/project/region/day multiply; `by_account=True` joins on it), a bucket with several storage
or operation types repeats its other costs on each row, NULL region/project keep the spine row
with zero costs (`null_safe=True` matches NULLs), and network categories outside the fixed list
are dropped from every total (`unlisted=True` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.constants import (CLASS_A_CAT, CLASS_B_CAT, LABEL_BUCKET_NAME, OTHERS_CAT,
                                 STORAGE_CAT, STORAGE_NETWORK_COLUMNS, STORAGE_SERVICE_ID, TEXT_DEFAULT)
from costframe.functions.categories import sanitize_name, storage_category
from costframe.functions.costs import net_cost
from costframe.functions.labels import label_value
from costframe.functions.time import days_in_month, la_date
from costframe.operators.pivot import fixed_pivot_sum, row_total
from costframe.plans.common import apply_day_filters, money_to_double
from costframe.schema import MONEY, WIDE_MONEY

JOIN_KEYS = ("bucket_name", "region", "project_name", "usage_date", "invoice_month")
UNLISTED = "NETWORK_UNLISTED"
SPINE = ("billing_name", "invoice_month", "usage_date", "project_name", "region", "bucket_name")


def storage_lines(billing: DataFrame, target_date=None, date_range=None, pad_days=None) -> DataFrame:
    """Storage lines with the report keys, net cost and month-scaled usage. The description stays
    raw: its category and sanitised name are derived after aggregation (once per group)."""
    lines = billing.filter(F.col("service.id") == STORAGE_SERVICE_ID)
    lines = apply_day_filters(lines, target_date, date_range, pad_days)
    day = la_date("usage_start_time")
    return lines.select(
        F.col("billing_account_id").alias("billing_name"),
        F.col("invoice.month").alias("invoice_month"),
        day.alias("usage_date"),
        F.col("project.name").alias("project_name"),
        F.col("location.location").alias("region"),
        net_cost().alias("total_cost"),
        (F.col("usage.amount_in_pricing_units").cast(WIDE_MONEY) * days_in_month(day).cast("decimal(2,0)")).alias("total_usage"),
        F.coalesce(label_value(LABEL_BUCKET_NAME), F.lit(TEXT_DEFAULT)).alias("bucket_name"),
        F.col("sku.description").alias("description"),
    )


def storage_bucket_cost(billing: DataFrame, target_date=None, date_range=None, pad_days=None,
                        by_account: bool = False, null_safe: bool = False,
                        money_as_double: bool = True, display_order: bool = False, unlisted: bool = False) -> DataFrame:
    """R4. `display_order=True` sorts by storage cost (descending) for display; the row set is
    the same (an order means nothing to a table insert). `unlisted=True` adds NETWORK_UNLISTED, the cost of
    download and egress categories outside the fixed list, and counts it in NETWORK_PRICE and SUBTOTAL."""
    lines = storage_lines(billing, target_date, date_range, pad_days)
    keys = list(JOIN_KEYS) + (["billing_name"] if by_account else [])
    # One aggregate of the lines, at (spine, raw description); category and sanitised name are
    # functions of the description, so the regex runs once per group instead of once per line.
    pre = (lines.groupBy(*SPINE, "description")
           .agg(F.sum("total_cost").alias("cost"), F.sum("total_usage").alias("usage"))
           .select(*SPINE, storage_category("description").alias("sku_category"),
                   sanitize_name("description").alias("sku_description"), "cost", "usage"))
    pre = pre.repartition(*keys)
    # several raw descriptions can share one sanitised name: re-sum at the report grain
    named = (pre.groupBy(*SPINE, "sku_category", "sku_description")
             .agg(F.sum("cost").alias("cost"), F.sum("usage").alias("usage")))
    pivot_cols = list(STORAGE_NETWORK_COLUMNS) + [OTHERS_CAT]
    network = list(STORAGE_NETWORK_COLUMNS)
    if unlisted:
        network.append(UNLISTED)
        listed = F.col("sku_category").isin(STORAGE_CAT, CLASS_A_CAT, CLASS_B_CAT, *pivot_cols)
        named = named.withColumn("sku_category", F.when(F.col("sku_category").isNotNull() & ~listed, UNLISTED).otherwise(F.col("sku_category")))
        pivot_cols.append(UNLISTED)
    alone = [c for c in SPINE if c not in keys]
    row = F.struct("sku_description", "cost", "usage")

    def rows_of(cat: str) -> Column:
        return F.collect_list(F.when(F.col("sku_category") == cat, row))

    folded = named.groupBy(*keys).agg(
        F.collect_set(F.struct(*alone, F.lit(0).alias("_one"))).alias("_spine"),
        rows_of(STORAGE_CAT).alias("_storage"), rows_of(CLASS_A_CAT).alias("_class_a"), rows_of(CLASS_B_CAT).alias("_class_b"),
        *fixed_pivot_sum("sku_category", "cost", pivot_cols))
    if not null_safe:  # a NULL key equals nothing: its spine rows stay, without costs
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        lists = ["_storage", "_class_a", "_class_b"]
        folded = folded.select(*keys, "_spine", *[F.when(whole, F.col(c)).alias(c) for c in lists + pivot_cols])
    zero = F.lit(0).cast(MONEY)
    out = folded.select(
        *keys, F.explode("_spine").alias("_s"), "_storage", "_class_a", "_class_b",
        *[F.coalesce(F.col(c), zero).alias(c) for c in network],
        row_total(network, zero).alias("NETWORK_PRICE"),
        F.coalesce(F.col(OTHERS_CAT), zero).alias(OTHERS_CAT))
    out = out.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in alone], *[c for c in out.columns if c not in (*keys, "_s")])
    for name in ("storage", "class_a", "class_b"):
        out = out.select("*", F.explode_outer(f"_{name}").alias(f"_{name}_row")).drop(f"_{name}")
    out = out.select(
        "*",
        F.col("_storage_row.sku_description").alias("STORAGE_TYPE"), F.col("_storage_row.cost").alias("STORAGE"),
        F.col("_storage_row.usage").alias("STORAGE_USAGE"),
        F.col("_class_a_row.sku_description").alias("STANDARD_CLASS_A_OPERATIONS_TYPE"),
        F.col("_class_a_row.cost").alias("STANDARD_CLASS_A_OPERATIONS"),
        F.col("_class_b_row.sku_description").alias("STANDARD_CLASS_B_OPERATIONS_TYPE"),
        F.col("_class_b_row.cost").alias("STANDARD_CLASS_B_OPERATIONS"))
    out = out.select(
        *SPINE,
        row_total(["STORAGE", "STANDARD_CLASS_A_OPERATIONS", "STANDARD_CLASS_B_OPERATIONS",
                   "NETWORK_PRICE", OTHERS_CAT], zero).alias("SUBTOTAL"),
        F.coalesce("STORAGE_TYPE", F.lit(TEXT_DEFAULT)).alias("STORAGE_TYPE"),
        F.coalesce("STORAGE", zero).alias("STORAGE"),
        F.coalesce("STORAGE_USAGE", zero).alias("USAGE_GB"),
        F.coalesce("STANDARD_CLASS_A_OPERATIONS_TYPE", F.lit(TEXT_DEFAULT)).alias("STANDARD_CLASS_A_OPERATIONS_TYPE"),
        F.coalesce("STANDARD_CLASS_A_OPERATIONS", zero).alias("STANDARD_CLASS_A_OPERATIONS"),
        F.coalesce("STANDARD_CLASS_B_OPERATIONS_TYPE", F.lit(TEXT_DEFAULT)).alias("STANDARD_CLASS_B_OPERATIONS_TYPE"),
        F.coalesce("STANDARD_CLASS_B_OPERATIONS", zero).alias("STANDARD_CLASS_B_OPERATIONS"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in network],
        F.coalesce("NETWORK_PRICE", zero).alias("NETWORK_PRICE"),
        F.coalesce(OTHERS_CAT, zero).alias(OTHERS_CAT),
    )
    if display_order:
        out = out.orderBy(F.col("STORAGE").desc())
    return money_to_double(out) if money_as_double else out
