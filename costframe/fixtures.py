"""Derived input tables over the driver's parquet tables (see FIXTURES.md).

These are the test stand-ins for the real exports: a billing export from lineitem x orders, a
price catalogue from part x nation, monitoring points from events, and fleet specs from part.
Each is plain DataFrame code, so its size grows with the source tables. `costframe.oracle_sql`
repeats the same derivations in DuckDB SQL for the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.constants import (COMPUTE_SERVICE_ID, GCE_INSTANCE, GCS_BUCKET, NAT_RECEIVED_METRIC,
                                 NAT_SENT_METRIC, OBJECT_COUNT_METRIC, PRICE_LIST_EXTRA_SERVICE_ID,
                                 STORAGE_SERVICE_ID, CONFIDENTIAL_CPU_SKU, CONFIDENTIAL_RAM_SKU)
from costframe.operators.joins import broadcast_if_small
from costframe.operators.local import local_table
from costframe.oracle_patterns import wording_rows
from costframe.schema import BILLING_EXPORT, MACHINE_CATALOG, MONEY, PRICING_EXPORT

# ---------------------------------------------------------------------------------------------
# Fixed values of the synthetic fixtures (documented in FIXTURES.md)
# ---------------------------------------------------------------------------------------------
COMPUTE_DESCRIPTIONS = (
    "N2 Instance Core running in Americas",
    "N2 Instance Ram running in Americas",
    "Nvidia Tesla T4 GPU running in Americas",
    "SSD backed PD Capacity in Americas",
    "SSD backed Local Storage in Americas",
    "Storage PD Capacity",
    "Network Inter Zone Egress",
    "External IP Charge on a Standard VM",
    "Static Ip Charge",
    None,
)
STORAGE_DESCRIPTIONS = (
    "Standard Storage US Multi-region",
    "Nearline Storage Iowa",
    "Coldline Storage Iowa",
    "Download APAC",
    "Download Worldwide Destinations (excluding Asia & Australia)",
    "Regional Standard Class A Operations",
    "Regional Standard Class B Operations",
    "GCP Storage egress between NA and EU",
    "Inter-region GCP Storage egress within EU",
    "GCP Storage egress between ME and EU",
    "Download Australia",
    "Download China",
    "APAC based Storage egress via peered/interconnect network",
    "EU based Storage egress via peered/interconnect network",
    "GCP Storage egress between APAC and SA",
    "GCP Storage egress between AU and APAC",
    "GCP Storage egress between AU and EU",
    "GCP Storage egress between AU and NA",
    "GCP Storage egress between AU and SA",
    "GCP Storage egress between EU and APAC",
    "GCP Storage egress between EU and SA",
    "GCP Storage egress between NA and APAC",
    "GCP Storage egress between NA and SA",
    "Inter-region GCP Storage egress within APAC",
    "Inter-region GCP Storage egress within AU",
    "Inter-region GCP Storage egress within NA",
    "Inter-region GCP Storage egress within SA",
    "NA based Storage egress via peered/interconnect network",
    "Networking Traffic Egress GAE Firebase Storage",
)
OTHER_DESCRIPTION = "Generic usage"
BILLING_LOCATIONS = ("us-east4", "us-central1", "asia-east1", "europe-west1", None)
METRIC_REGIONS = ("us-east4", "us-central1", "asia-east1", "europe-west1")
STORAGE_CLASSES = ("STANDARD", "NEARLINE", "COLDLINE")
OTHER_METRIC = "compute.googleapis.com/instance/cpu/utilization"
# place text and region list of a price-list row, by p_partkey % 6
PRICE_PLACES = (
    ("Americas", ("us-east4", "us-central1")),
    ("Virginia", ("us-east4",)),
    ("Taiwan", ("asia-east1",)),
    ("Iowa", ("us-central1",)),
    ("Warsaw", ("europe-central2", "europe-west1")),
    ("Delhi", ()),
)
UNMATCHED_PRICE_ROWS = 6          # extra description slots that match no pattern
MACHINE_CATALOG_ROWS = (
    ("n2-standard-2", "n2", 2.0, 8.0),
    ("n2-highmem-80", "n2", 80.0, 640.0),
    ("c3-standard-176", "c3", 176.0, 704.0),
    ("a2-highgpu-1g", "a2", 12.0, 85.0),
    ("e2-standard-4", "e2", 4.0, 16.0),
)
FLEET_MACHINES = (
    "n2-standard-2",
    "n2-custom-8-65536",
    "custom-48-163840",
    "nvidia-tesla-t4_4_custom-48-163840",
    "tdx_c3-standard-176",
    "n2-standard-2-16lssd",
    "no-such-type",
    "n2-custom-8-65536-ext",
)
FLEET_DISK = "local-ssd-9000_pd-standard-200"
FLEET_REGIONS = ("us-east4", "us-central1", "asia-east1", "europe-west1", "europe-central2")
BASE_USAGE_TS = "2024-01-01 00:00:00"
BASE_PRICE_DATE = "2024-03-01"


def _pick(idx: Column, values) -> Column:
    """values[idx] as a CASE expression (NULL entries give NULL)."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v)))
    return expr


def _q(v) -> str:
    """Spark SQL literal."""
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(expr: str, values) -> str:
    return "(CASE " + " ".join(f"WHEN {expr} = {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END)"


def _s(c: Column) -> Column:
    return c.cast("string")


_READS: dict[tuple[int, str], DataFrame] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's table (a plain parquet scan). The DataFrame is kept per session and path so
    repeated derivations do not re-list files and re-read footers; it is re-executed on every
    use (nothing is cached in memory)."""
    key = (id(spark), f"{sf_dir}/{name}.parquet")
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READS[key] = spark.read.parquet(key[1])
    return df


def _spread(df: DataFrame) -> DataFrame:
    """Round-robin over the cluster when the scan gives fewer splits than cores.

    The driver's tables are single-row-group files, which parquet cannot split, so the per-line
    work would run in one task. Real exports (many files / row groups) already have more splits
    than cores, and then nothing is added (no shuffle).
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: leave the plan as is
        return df
    return df.repartition(cores) if splits < cores else df


def _typed(exprs: dict[str, str], schema) -> list[str]:
    return [f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]


_KV_ARRAY = "ARRAY<STRUCT<key:STRING,value:STRING>>"


def billing_lines(spark: SparkSession, sf_dir: str, account: int | None = None) -> DataFrame:
    """One narrow row per lineitem: the values that `as_export` makes a billing line of, and its export day.

    A line as exported is some ten times as wide, so a write by export day deals out these rows.
    """
    li = _spread(_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax"))
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if account is not None:
        od = od.filter(F.col("o_custkey") % 4 == account)
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    base = j.selectExpr(
        "l_orderkey * 7 + l_linenumber AS h", "l_suppkey % 6 AS svc", "l_partkey AS pk", "l_suppkey",
        "l_quantity", "l_discount", "l_tax", "o_custkey",
        f"timestampadd(HOUR, CAST((l_orderkey * 7 + l_linenumber) % 2160 AS INT), TIMESTAMP_NTZ'{BASE_USAGE_TS}') AS st",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price")
    return base.selectExpr("*", "date_add(to_date(st), CAST(h % 3 AS INT)) AS partition_date")


def billing_export(spark: SparkSession, sf_dir: str, account: int | None = None) -> DataFrame:
    """One billing line per lineitem (FIXTURES.md, `billing_export`).

    With `account`, only that billing account's lines (orders with o_custkey % 4 = account):
    the per-account tables of the multi-account union.
    """
    return as_export(billing_lines(spark, sf_dir, account))


def as_export(lines: DataFrame) -> DataFrame:
    """`billing_lines` with the columns of the export. The projection is Spark SQL text (one
    parser call instead of thousands of Python-to-JVM calls for the expression tree)."""
    return lines.selectExpr(*_typed(_export_exprs(), BILLING_EXPORT))


def export_column(name: str) -> Column:
    """The export's column `name` of `billing_lines`."""
    return F.expr(_typed({name: _export_exprs()[name]}, T.StructType([BILLING_EXPORT[name]]))[0])


def _export_exprs() -> dict[str, str]:
    def kv(key, value, cond):
        return f"CASE WHEN {cond} THEN named_struct('key', '{key}', 'value', {value}) END"

    compute_labels = ", ".join([
        kv("instance_name", "concat('vm-', CAST(pk % 50 AS STRING))", "h % 3 <> 0"),
        kv("psm", "concat('psm-', CAST(pk % 7 AS STRING))", "h % 5 = 0"),
        kv("inner_ip", "concat('10.0.0.', CAST(pk % 5 AS STRING))", "h % 7 = 0"),
        kv("forwarding-rule-name", "concat('fr-', CAST(pk % 11 AS STRING))", "h % 9 = 0"),
        kv("instance_name", "'vm-again'", "h % 29 = 0"),
        "CASE WHEN h % 31 = 0 THEN named_struct('key', CAST(NULL AS STRING), 'value', 'no key') END",
    ])
    storage_labels = kv("bucket_name", "concat('bkt-', CAST(pk % 13 AS STRING))", "h % 4 <> 0")
    storage_labels += ", " + kv("bucket_name", "'bkt-again'", "h % 29 = 0")
    # written out, as a lambda call per line costs more than both credits
    discounted, promoted = "l_discount > 0", "l_tax > CAST(0.05 AS DOUBLE)"
    discount = """named_struct('type', CASE WHEN h % 17 <> 0 THEN 'SUSTAINED_USAGE_DISCOUNT' END,
        'amount', CASE WHEN h % 19 <> 0 THEN CAST(-(price * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,6)) END)"""
    promotion = "named_struct('type', 'PROMOTION', 'amount', CAST(-(price * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(18,6)))"
    la_day = "to_date(convert_timezone('UTC', 'America/Los_Angeles', st))"
    return {
        "billing_account_id": "concat('BA-', CAST(o_custkey % 4 AS STRING))",
        "service": f"""named_struct(
            'id', CASE WHEN svc < 3 THEN '{COMPUTE_SERVICE_ID}' WHEN svc IN (3, 4) THEN '{STORAGE_SERVICE_ID}'
                       ELSE concat('SVC-', CAST(pk % 4 AS STRING)) END,
            'description', CASE WHEN svc < 3 THEN 'Compute Engine' WHEN svc IN (3, 4) THEN 'Cloud Storage'
                                ELSE 'Other service' END)""",
        "sku": f"""named_struct(
            'id', CASE WHEN svc < 5 THEN concat('SKU-', CAST(pk AS STRING)) ELSE concat('SKU-X', CAST(pk % 4 AS STRING)) END,
            'description', CASE WHEN svc < 3 THEN {_case('pk % 10', COMPUTE_DESCRIPTIONS)}
                                WHEN svc IN (3, 4) THEN {_case(f'pk % {len(STORAGE_DESCRIPTIONS)}', STORAGE_DESCRIPTIONS)}
                                ELSE {_q(OTHER_DESCRIPTION)} END)""",
        "usage_start_time": "st",
        "usage_end_time": "st + INTERVAL 1 HOUR",
        "project": """named_struct(
            'id', CASE WHEN o_custkey % 10 <> 9 THEN concat('proj-', CAST(o_custkey % 10 AS STRING)) END,
            'name', CASE WHEN o_custkey % 10 <> 9 THEN concat('Project ', CAST(o_custkey % 10 AS STRING)) END)""",
        "labels": f"""CASE WHEN svc < 3 THEN filter(array({compute_labels}), x -> x IS NOT NULL)
                           WHEN svc IN (3, 4) THEN filter(array({storage_labels}), x -> x IS NOT NULL)
                           WHEN h % 2 = 0 THEN CAST(NULL AS {_KV_ARRAY})
                           ELSE CAST(array() AS {_KV_ARRAY}) END""",
        "system_labels": f"CAST(array() AS {_KV_ARRAY})",
        "location": f"named_struct('location', {_case('l_suppkey % 5', BILLING_LOCATIONS)})",
        "resource": """CASE
            WHEN svc IN (3, 4) THEN named_struct('name', CAST(NULL AS STRING),
                 'global_name', concat('//storage.googleapis.com/projects/_/buckets/bkt-', CAST(pk % 13 AS STRING)))
            WHEN svc < 3 AND h % 9 = 0 THEN named_struct('name', concat('fr-', CAST(pk % 11 AS STRING)),
                 'global_name', concat('//compute.googleapis.com/forwardingRules/fr-', CAST(pk % 11 AS STRING)))
            WHEN svc < 3 AND h % 3 <> 0 THEN named_struct('name', concat('vm-', CAST(pk % 50 AS STRING)),
                 'global_name', concat('//compute.googleapis.com/instances/vm-', CAST(pk % 50 AS STRING)))
            END""",
        "tags": f"CAST(array() AS {_KV_ARRAY})",
        "export_time": "st + INTERVAL 1 HOUR + make_dt_interval(CAST(h % 3 AS INT))",
        "cost": "CASE WHEN h % 37 <> 0 THEN CAST(price AS DECIMAL(18,6)) END",
        "currency": "'USD'",
        "currency_conversion_rate": "1",
        "usage": "named_struct('amount_in_pricing_units', CAST(l_quantity AS DECIMAL(18,6)))",
        "credits": f"""CASE WHEN {discounted} AND {promoted} THEN array({discount}, {promotion})
                            WHEN {discounted} THEN array({discount}) WHEN {promoted} THEN array({promotion}) ELSE array() END""",
        "invoice": f"named_struct('month', date_format({la_day}, 'yyyyMM'))",
        "cost_type": "'regular'",
        "adjustment_info": "NULL", "price": "NULL", "cost_at_list": "NULL", "transaction_type": "NULL",
        "seller_name": "NULL", "subscription": "NULL",
        "partition_date": "partition_date",
    }


def account_tables(spark: SparkSession, sf_dir: str, n: int = 4) -> list[DataFrame]:
    """The four per-account billing tables: the export split by billing account."""
    return [billing_export(spark, sf_dir, account=i) for i in range(n)]


def price_description_rows() -> list[tuple[int, str, bool, str, bool]]:
    """(slot, head, uses_place, tail, three_year): one slot per pattern row made into a matching
    price-list description, plus unmatched slots. The description is
    head || place (if uses_place) || tail || 's' (3-year rows with an even p_partkey / 8)."""
    out = []
    for i, (_kind, _comp, first, last) in enumerate(wording_rows()):
        uses_place = first.endswith("%")
        head = first[:-1] + " " if uses_place else first
        three = last is not None and "3 Year" in last
        tail = "" if last is None else (" for 3 Year" if three else " for 1 Year")
        out.append((i, head, uses_place, tail, three))
    n = len(out)
    for k in range(UNMATCHED_PRICE_ROWS):
        out.append((n + k, "Licence fee in ", True, f" (class {k})", False))
    return out


def pricing_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three price snapshots per part, numbered like nation keys 0..2 (FIXTURES.md, `pricing_export`)."""
    part = _spread(_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"))
    slots = local_table(spark, price_description_rows(), T.StructType([
        T.StructField("slot", T.IntegerType()), T.StructField("head", T.StringType()),
        T.StructField("uses_place", T.BooleanType()), T.StructField("tail", T.StringType()),
        T.StructField("three_year", T.BooleanType())]))
    n_slots = len(price_description_rows())
    p = F.col("p_partkey")
    # three snapshots per part (nation keys 0..2 in the oracle): a fixed x3 explode, no join
    x = part.withColumn("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(2))))
    x = x.withColumn("slot", ((p / 4).cast("bigint") % n_slots).cast("int"))
    x = x.join(broadcast_if_small(slots), "slot")
    # every fifth SKU is listed twice in a snapshot; the later export has another price
    x = x.withColumn("again", F.explode(F.when(p % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    r = p % 6
    place = _pick(r, [pl for pl, _ in PRICE_PLACES])
    regions = None
    for i, (_pl, regs) in enumerate(PRICE_PLACES):
        arr = F.array(*[F.lit(g) for g in regs]) if regs else F.array().cast("array<string>")
        regions = F.when(r == i, arr) if regions is None else regions.when(r == i, arr)
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    k = (F.col("n_nationkey") + 10 + F.col("again") * 7).cast("bigint")

    def money(scale: str) -> Column:
        return (cents * k * F.lit(scale).cast("decimal(8,7)")).cast(MONEY)

    tier = "array<struct<start_usage_amount:decimal(18,6),usd_amount:decimal(18,6)>>"
    list_tiers = F.when(p % 9 == 0, F.lit(None).cast(tier)).otherwise(F.array(
        F.struct(F.lit(0).cast(MONEY).alias("start_usage_amount"), money("0.000002").alias("usd_amount")),
        F.struct(F.lit(100).cast(MONEY).alias("start_usage_amount"), money("0.000001").alias("usd_amount"))))
    acct_tiers = F.when(p % 11 == 0, F.array().cast(tier)).otherwise(F.array(
        F.struct(F.lit(0).cast(MONEY).alias("start_usage_amount"), money("0.000001").alias("usd_amount"))))
    plural = F.when(F.col("three_year") & ((p / 8).cast("bigint") % 2 == 0), F.lit("s")).otherwise(F.lit(""))
    description = F.concat(F.col("head"), F.when(F.col("uses_place"), place).otherwise(F.lit("")),
                           F.col("tail"), plural)
    pdate = F.date_add(F.lit(BASE_PRICE_DATE).cast("date"), F.col("n_nationkey"))
    out = x.select(
        F.struct(
            F.when(p == 6, F.lit(CONFIDENTIAL_CPU_SKU)).when(p == 7, F.lit(CONFIDENTIAL_RAM_SKU))
            .otherwise(F.concat(F.lit("SKU-"), _s(p))).alias("id"),
            description.alias("description")).alias("sku"),
        F.struct(
            F.when(p % 4 == 0, STORAGE_SERVICE_ID).when(p % 4 == 1, PRICE_LIST_EXTRA_SERVICE_ID)
            .otherwise(COMPUTE_SERVICE_ID).alias("id")).alias("service"),
        F.struct(regions.alias("regions")).alias("geo_taxonomy"),
        F.struct(list_tiers.alias("tiered_rates")).alias("list_price"),
        F.struct(acct_tiers.alias("tiered_rates")).alias("billing_account_price"),
        (F.to_timestamp_ntz(pdate.cast("string")) + F.expr("make_dt_interval(0, 6 + 5 * again)")).alias("export_time"),
        pdate.alias("partition_date"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PRICING_EXPORT.fields])


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring points from events (FIXTURES.md, `metric_points`)."""
    ev = _spread(_table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value"))
    u = F.col("user_id")
    et = F.col("event_type")
    metric = (F.when(et.isin("view", "click"), NAT_RECEIVED_METRIC)
              .when(et == "purchase", NAT_SENT_METRIC)
              .when(et == "signup", OBJECT_COUNT_METRIC)
              .otherwise(OTHER_METRIC))
    return ev.select(
        metric.alias("metric"),
        F.when(et == "signup", GCS_BUCKET).otherwise(GCE_INSTANCE).alias("resource_type"),
        F.concat(F.lit("proj-"), _s(u % 3)).alias("project_id"),
        F.concat(F.lit("nat-"), _s(u % 8)).alias("nat_gateway_name"),
        _pick(u % 4, METRIC_REGIONS).alias("region"),
        F.concat(F.lit("psm-"), _s(u % 5)).alias("psm"),
        F.concat(F.lit("vm-"), _s(u)).alias("instance_name"),
        F.concat(F.lit("10.0.0."), _s(u % 32)).alias("inner_ip"),
        F.concat(F.lit("bkt-"), _s(u % 13)).alias("bucket_name"),
        _pick(u % 3, STORAGE_CLASSES).alias("storage_class"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.when(et == "signup", F.round(F.col("value")))
        .otherwise(F.round(F.col("value") * 1000000)).cast("double").alias("value"),
    )


def machine_catalog(spark: SparkSession) -> DataFrame:
    """Machine-type catalogue (name -> family, vCPU, GiB); a dimension table."""
    return local_table(spark, MACHINE_CATALOG_ROWS, MACHINE_CATALOG)


def fleet_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One machine spec per part, every seventh listed twice (FIXTURES.md, `fleet_specs`)."""
    p = F.col("p_partkey")
    times = F.explode(F.when(p % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return _spread(_table(spark, sf_dir, "part")).withColumn("again", times).select(
        p.cast("bigint").alias("spec_id"),
        _pick(p % 8, FLEET_MACHINES).alias("machine_definition"),
        F.when(p % 3 == 0, F.lit(FLEET_DISK)).alias("disk_definition"),
        _pick(p % 5, FLEET_REGIONS).alias("region"),
    )
