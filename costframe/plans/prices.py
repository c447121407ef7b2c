"""Price catalogue jobs: newest price list (X2), first-tier price pairs (X3), SKU lookups
and the disk price table (R7). The snapshot is small (one row per SKU); it is joined as a
measured dimension (`broadcast_dimension`), never collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.constants import PRICE_LIST_SERVICES
from costframe.operators.joins import broadcast_dimension
from costframe.plans.common import money_to_double
from costframe.sources.pricing import latest_snapshot

SKU_NOT_FOUND = "SKU not found"


def latest_prices(pricing: DataFrame, services=PRICE_LIST_SERVICES) -> DataFrame:
    """Newest snapshot of the listed services, one row per SKU with both price books.

    A SKU that the snapshot lists more than once keeps the row exported last (ties: the largest
    description, then prices), so joins on `sku_id` never multiply rows.
    """
    snap = latest_snapshot(pricing)
    if services is not None:
        snap = snap.filter(F.col("service.id").isin(*services))
    row = F.struct("export_time", F.col("sku.description").alias("sku_description"), "list_price", "billing_account_price")
    one = snap.groupBy(F.col("sku.id").alias("sku_id")).agg(F.max(row).alias("newest"))
    return one.select(
        "sku_id", "newest.sku_description", "newest.list_price", "newest.billing_account_price",
        F.to_date("newest.export_time").alias("pricing_date"),
    )


def first_tier(book: str) -> F.Column:
    """First tier's usd_amount when the book has a non-empty tier list, else NULL."""
    tiers = F.col(f"{book}.tiered_rates")
    return F.when(F.size(tiers) > 0, F.get(tiers, 0)["usd_amount"])


def first_tier_prices(pricing: DataFrame, services=PRICE_LIST_SERVICES) -> DataFrame:
    """(sku_id, list_price, account_price); each price present only if its own tiers are
    non-empty; SKUs with neither are dropped."""
    lp = latest_prices(pricing, services)
    out = lp.select("sku_id", first_tier("list_price").alias("list_price"),
                    first_tier("billing_account_price").alias("account_price"))
    return out.filter(F.col("list_price").isNotNull() | F.col("account_price").isNotNull())


def sku_price_lookup(pricing: DataFrame, requested: DataFrame, flatten: bool = True) -> DataFrame:
    """The newest snapshot's fields for each requested `sku_id` (any service); a SKU absent
    from the snapshot gets `error = 'SKU not found'`. `flatten=False` keeps the full price-book
    structs (all tiers) instead of the first-tier prices and tier count."""
    snap = latest_prices(pricing, services=None)
    if flatten:
        found = snap.select(
            "sku_id", "sku_description",
            first_tier("list_price").alias("list_price"),
            first_tier("billing_account_price").alias("account_price"),
            F.size(F.coalesce(F.col("list_price.tiered_rates"), F.array())).cast("bigint").alias("n_list_tiers"),
            "pricing_date")
    else:
        found = snap
    out = requested.select("sku_id").join(broadcast_dimension(found, "snapshot"), "sku_id", "left")
    out = out.withColumn("error", F.when(F.col("pricing_date").isNull(), F.lit(SKU_NOT_FOUND)))
    return money_to_double(out)


def disk_prices(sku_map: DataFrame, prices: DataFrame) -> DataFrame:
    """For each disk type and region in the SKU map, list and account price on demand and
    under 1-/3-year commitment. A term with no SKU (or no price) is NULL."""
    disk = sku_map.filter(F.col("kind") == "disk")
    term = F.regexp_extract("component", r"-cud-([13])y$", 1)
    disk = disk.select(
        F.regexp_replace("component", r"-cud-[13]y$", "").alias("disk_type"), "region",
        F.when(term == "", "ondemand").otherwise(F.concat(F.lit("cud_"), term, F.lit("y"))).alias("term"),
        "sku_id")
    priced = disk.join(broadcast_dimension(prices, "price-pairs"), "sku_id", "left")
    aggs = []
    for t in ("ondemand", "cud_1y", "cud_3y"):
        for col, name in (("list_price", "list_price"), ("account_price", "account_price")):
            aggs.append(F.max(F.when(F.col("term") == t, F.col(col))).alias(f"{t}_{name}"))
    return money_to_double(priced.groupBy("disk_type", "region").agg(*aggs))
