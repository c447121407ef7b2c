"""Explicit schemas for the input and report tables (no inference on read)."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 6)       # derived test tables
WIDE_MONEY = T.DecimalType(28, 12)   # money read from exports, and every sum on the way

KV = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
CREDIT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("amount", MONEY),
])
TIER = T.StructType([
    T.StructField("start_usage_amount", MONEY),
    T.StructField("usd_amount", MONEY),
])
PRICE_BOOK = T.StructType([T.StructField("tiered_rates", T.ArrayType(TIER))])


def _struct(*names, dtype=T.StringType()):
    return T.StructType([T.StructField(n, dtype) for n in names])


BILLING_EXPORT = T.StructType([
    T.StructField("billing_account_id", T.StringType()),
    T.StructField("service", _struct("id", "description")),
    T.StructField("sku", _struct("id", "description")),
    T.StructField("usage_start_time", T.TimestampNTZType()),
    T.StructField("usage_end_time", T.TimestampNTZType()),
    T.StructField("project", _struct("id", "name")),
    T.StructField("labels", T.ArrayType(KV)),
    T.StructField("system_labels", T.ArrayType(KV)),
    T.StructField("location", _struct("location")),
    T.StructField("resource", _struct("name", "global_name")),
    T.StructField("tags", T.ArrayType(KV)),
    T.StructField("export_time", T.TimestampNTZType()),
    T.StructField("cost", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("currency_conversion_rate", MONEY),
    T.StructField("usage", T.StructType([T.StructField("amount_in_pricing_units", MONEY)])),
    T.StructField("credits", T.ArrayType(CREDIT)),
    T.StructField("invoice", _struct("month")),
    T.StructField("cost_type", T.StringType()),
    T.StructField("adjustment_info", _struct("id", "description")),
    T.StructField("price", T.StructType([T.StructField("effective_price", MONEY)])),
    T.StructField("cost_at_list", MONEY),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("seller_name", T.StringType()),
    T.StructField("subscription", _struct("instance_id")),
    T.StructField("partition_date", T.DateType()),
])

# The 25 export columns in the order a union branch lists them (partition column excluded).
BILLING_COLUMNS = tuple(f.name for f in BILLING_EXPORT.fields if f.name != "partition_date")

PRICING_EXPORT = T.StructType([
    T.StructField("sku", _struct("id", "description")),
    T.StructField("service", _struct("id")),
    T.StructField("geo_taxonomy", T.StructType([T.StructField("regions", T.ArrayType(T.StringType()))])),
    T.StructField("list_price", PRICE_BOOK),
    T.StructField("billing_account_price", PRICE_BOOK),
    T.StructField("export_time", T.TimestampNTZType()),
    T.StructField("partition_date", T.DateType()),
])

SKU_PATTERNS = T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("component", T.StringType(), False),
    T.StructField("like_first", T.StringType(), False),
    T.StructField("like_last", T.StringType(), True),
])

SKU_MAP = _struct("kind", "component", "region", "sku_id")

MACHINE_CATALOG = T.StructType([
    T.StructField("machine_type", T.StringType(), False),
    T.StructField("family", T.StringType(), False),
    T.StructField("cpu", T.DoubleType(), False),
    T.StructField("ram_gb", T.DoubleType(), False),
])

FLEET_SPECS = T.StructType([
    T.StructField("spec_id", T.LongType()),
    T.StructField("machine_definition", T.StringType()),
    T.StructField("disk_definition", T.StringType()),
    T.StructField("region", T.StringType()),
])

METRIC_POINTS = T.StructType(
    [T.StructField("metric", T.StringType()), T.StructField("resource_type", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in (
        "project_id", "nat_gateway_name", "region", "psm", "instance_name", "inner_ip",
        "bucket_name", "storage_class")]
    + [T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())]
)
METRIC_LABELS = tuple(f.name for f in METRIC_POINTS.fields if f.name not in ("metric", "resource_type", "ts", "value"))

NAT_REPORT = T.StructType([
    T.StructField("project_id", T.StringType()),
    T.StructField("nat_gateway_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("psm", T.StringType()),
    T.StructField("instance_name", T.StringType()),
    T.StructField("inner_ip", T.StringType()),
    T.StructField("usage_date", T.DateType()),
    T.StructField("received_bytes_count", T.DoubleType()),
    T.StructField("sent_bytes_count", T.DoubleType()),
    T.StructField("nat_fee_usd", T.DoubleType()),
])
