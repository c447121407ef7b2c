"""Monthly price estimates for machine fleets (R6) and machine comparisons.

Specs stay distributed. Each spec string is parsed with column expressions (split / filter /
element_at / try_cast, no UDF), expanded into its price lookups with one `explode`, joined to the
SKU map and to the first-tier prices (both small dimensions, broadcast when their size estimate
allows), and folded back with one `groupBy(spec)` of conditional sums. A missing lookup does not
fail the whole job: the spec's `status` names the first missing lookup (in the order the
lookups are made: on-demand, 1-year, 3-year; CPU, RAM, GPU, boot disk, local SSD; then the
confidential surcharges) and its prices are NULL.

Money is exact: quantities are DECIMAL(22,10) (GiB = MB x 1/1024 exactly), prices DECIMAL(18,9),
and totals are rounded to cents at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.constants import (CALCULATION_PERIOD, CONFIDENTIAL_CPU_SKU, CONFIDENTIAL_RAM_SKU,
                                 DEFAULT_BOOT_DISK, HOURS_PER_MONTH, LOCAL_SSD, MACHINE_SUFFIX_PATTERNS)
from costframe.operators.joins import broadcast_dimension

QTY = "decimal(22,10)"
PRICE = "decimal(18,9)"   # rates are not rounded; totals are, to cents
MB_TO_GIB = "0.0009765625"   # 1/1024, exact
TERMS = (("ondemand", 0), ("cud_1y", 10), ("cud_3y", 20))
OK = "OK"
SPEC_COLUMNS = ("machine_definition", "disk_definition", "region")


def _is_digits(t: Column) -> Column:
    return t.rlike("^[0-9]+$")


def parse_machine(spec: Column) -> dict[str, Column]:
    """Columns of a machine definition like `nvidia-tesla-t4_4_custom-48-163840`.

    Tokens on `_`: containing "nvidia" -> GPU type; all digits -> GPU count (default 0);
    containing "tdx" -> confidential; anything else -> machine name. For each, the last one wins.
    """
    toks = F.split(F.coalesce(spec, F.lit("")), "_")
    gpu = F.filter(toks, lambda t: t.contains("nvidia"))
    digits = F.filter(toks, lambda t: ~t.contains("nvidia") & _is_digits(t))
    rest = F.filter(toks, lambda t: ~t.contains("nvidia") & ~_is_digits(t))
    tdx = F.filter(rest, lambda t: t.contains("tdx"))
    names = F.filter(rest, lambda t: ~t.contains("tdx"))
    gpu_type = F.try_element_at(gpu, F.lit(-1))
    gpu_count = F.coalesce(F.try_element_at(digits, F.lit(-1)).try_cast("int"), F.lit(0))
    machine = F.try_element_at(names, F.lit(-1))
    canonical = F.when(gpu_type.isNotNull(),
                       F.concat_ws("_", gpu_type, gpu_count.cast("string"), machine)).otherwise(machine)
    return {
        "gpu_type": gpu_type, "gpu_count": gpu_count, "confidential": F.size(tdx) > 0,
        "machine": machine, "instance_type": F.when(machine.isNotNull(), canonical),
    }


def custom_shape(machine: Column) -> dict[str, Column]:
    """Custom names: 4 parts on `-` -> (part0, part2 vCPU, part3 MB); else family n1 and the
    last two parts. A part that is not a number gives NULL (invalid)."""
    parts = F.split(machine, "-")
    four = F.size(parts) == 4
    cpu_s = F.when(four, F.try_element_at(parts, F.lit(3))).otherwise(F.try_element_at(parts, F.lit(-2)))
    mb_s = F.when(four, F.try_element_at(parts, F.lit(4))).otherwise(F.try_element_at(parts, F.lit(-1)))
    return {
        "family": F.when(four, F.try_element_at(parts, F.lit(1))).otherwise(F.lit("n1")),
        "cpu": cpu_s.try_cast("decimal(20,4)"),
        "ram_gb": (mb_s.try_cast("decimal(12,0)") * F.lit(MB_TO_GIB).cast("decimal(11,10)")).cast("decimal(18,10)"),
    }


def strip_machine_suffixes(machine: Column) -> Column:
    out = machine
    for pat in MACHINE_SUFFIX_PATTERNS:
        out = F.regexp_replace(out, pat, "")
    return out


def parse_disk(disk: Column) -> dict[str, Column]:
    """`local-ssd-9000_pd-standard-200`: a token with "local-ssd" gives the local SSD size (last
    `-` part); another token gives the boot disk type (all but the last part) and size. No disk
    spec: pd-standard, 0 GB, no local SSD."""
    toks = F.split(disk, "_")
    local = F.try_element_at(F.filter(toks, lambda t: t.contains("local-ssd")), F.lit(-1))
    boot = F.try_element_at(F.filter(toks, lambda t: ~t.contains("local-ssd")), F.lit(-1))
    bparts = F.split(boot, "-")
    none = disk.isNull() | (disk == "")
    return {
        "has_local_ssd": ~none & local.isNotNull(),
        "local_ssd_gb": F.when(~none & local.isNotNull(),
                               F.try_element_at(F.split(local, "-"), F.lit(-1)).try_cast("int")),
        "boot_type": F.when(none, F.lit(DEFAULT_BOOT_DISK)).otherwise(
            F.array_join(F.slice(bparts, 1, F.size(bparts) - 1), "-")),
        "boot_gb": F.when(none, F.lit(0)).otherwise(F.try_element_at(bparts, F.lit(-1)).try_cast("int")),
        "boot_present": none | boot.isNotNull(),
    }


def parse_specs(specs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Spec columns plus family / vCPU / GiB and a parse status."""
    m = parse_machine(F.col("machine_definition"))
    d = parse_disk(F.col("disk_definition"))
    x = specs.select("*", *[v.alias(k) for k, v in m.items()], *[v.alias(k) for k, v in d.items()])
    x = x.withColumn("is_custom", F.col("machine").contains("custom"))
    cs = custom_shape(F.col("machine"))
    x = x.withColumn("lookup_name", F.when(~F.col("is_custom"), strip_machine_suffixes(F.col("machine"))))
    cat = broadcast_dimension(catalog.select(
        F.col("machine_type").alias("lookup_name"), F.col("family").alias("cat_family"),
        F.col("cpu").alias("cat_cpu"), F.col("ram_gb").alias("cat_ram")), "machine-catalog")
    x = x.join(cat, "lookup_name", "left")
    x = x.withColumn("family", F.when(F.col("is_custom"), cs["family"]).otherwise(F.col("cat_family")))
    x = x.withColumn("cpu", F.when(F.col("is_custom"), cs["cpu"]).otherwise(F.col("cat_cpu").cast("decimal(20,4)")))
    x = x.withColumn("ram_gb", F.when(F.col("is_custom"), cs["ram_gb"])
                     .otherwise(F.col("cat_ram").cast("decimal(18,10)")))
    status = (F.when(F.col("machine").isNull(), F.lit("invalid machine definition"))
              .when(F.col("is_custom") & (F.col("cpu").isNull() | F.col("ram_gb").isNull()),
                    F.lit("invalid custom machine type"))
              .when(~F.col("is_custom") & F.col("cat_family").isNull(), F.lit("unknown machine type"))
              .when(~F.col("boot_present") | F.col("boot_gb").isNull()
                    | (F.col("has_local_ssd") & F.col("local_ssd_gb").isNull()),
                    F.lit("invalid disk definition")))
    return x.withColumn("parse_status", status).drop("cat_family", "cat_cpu", "cat_ram", "lookup_name")


def _requests() -> Column:
    """Array of price lookups for one parsed spec, in the order they are made."""
    hours = F.lit(HOURS_PER_MONTH)
    cpu_q = (F.col("cpu") * hours).cast(QTY)
    ram_q = (F.col("ram_gb") * hours).cast(QTY)
    gpu_q = (F.col("gpu_count") * hours).cast(QTY)

    def req(seq, term, kind, comp, qty, when=None):
        s = F.struct(F.lit(seq).alias("seq"), F.lit(term).alias("term"), F.lit(kind).alias("kind"),
                     comp.alias("component"), qty.cast(QTY).alias("qty"))
        return s if when is None else F.when(when, s)

    out = []
    for term, base in TERMS:
        suffix = {"ondemand": None, "cud_1y": "-cud-1y", "cud_3y": "-cud-3y"}[term]
        fam_key = (F.concat(F.col("family"), F.lit(suffix)) if suffix else
                   F.concat(F.col("family"), F.when(F.col("is_custom"), F.lit("-custom"))
                            .otherwise(F.lit("-predefined"))))
        gpu_key = F.concat(F.col("gpu_type"), F.lit(suffix or ""))
        ssd_key = F.lit(LOCAL_SSD + (suffix or ""))
        out += [
            req(base + 0, term, "cpu", fam_key, cpu_q),
            req(base + 1, term, "ram", fam_key, ram_q),
            req(base + 2, term, "gpu", gpu_key, gpu_q, F.col("gpu_type").isNotNull()),
            req(base + 3, term, "disk", F.col("boot_type"), F.col("boot_gb")),
            req(base + 4, term, "disk", ssd_key, F.col("local_ssd_gb"), F.col("has_local_ssd")),
        ]
    conf = F.col("confidential")
    for term, base in (("ondemand", 30), ("cud_3y", 40)):
        out += [req(base, term, "sku", F.lit(CONFIDENTIAL_CPU_SKU), cpu_q, conf),
                req(base + 2, term, "sku", F.lit(CONFIDENTIAL_RAM_SKU), ram_q, conf)]
    return F.filter(F.array(*out), lambda r: r.isNotNull())


def fleet_estimate(specs: DataFrame, catalog: DataFrame, sku_map: DataFrame, prices: DataFrame,
                   id_col: str = "spec_id") -> DataFrame:
    """One row per spec with list/account price on demand, 1-year and 3-year commitment.

    `specs`: (id_col, machine_definition, disk_definition, region); `sku_map`: (kind, component,
    region, sku_id); `prices`: (sku_id, list_price, account_price) first-tier prices.
    """
    # Specs repeat: each distinct (machine, disk, region) is estimated once and joined back to every
    # input row (null-safe), so equal specs are neither summed together nor priced again.
    named = [id_col] + [c for c in SPEC_COLUMNS if c != id_col]
    rows = specs.select(*named)
    shapes = specs.select(*SPEC_COLUMNS).distinct()
    est = _estimate_shapes(shapes, catalog, sku_map, prices)
    cond = None
    for c in SPEC_COLUMNS:
        same = rows[c].eqNullSafe(est[f"_e_{c}"])
        cond = same if cond is None else cond & same
    joined = rows.join(est, cond, "left")
    out = [c for c in est.columns if not c.startswith("_e_")]
    return joined.select(F.col(id_col), "region", F.col("instance_type"), F.col("disk_definition").alias("disk_type"),
                         *[c for c in out if c != "instance_type"])


def _estimate_shapes(shapes: DataFrame, catalog: DataFrame, sku_map: DataFrame, prices: DataFrame) -> DataFrame:
    """Estimate of each distinct (machine_definition, disk_definition, region), named `_e_...`."""
    parsed = parse_specs(shapes, catalog)
    keys = [*SPEC_COLUMNS, "instance_type", "parse_status"]
    reqs = parsed.select(*keys, F.when(F.col("parse_status").isNull(), _requests()).alias("reqs"))
    ex = reqs.select(*keys, F.explode_outer("reqs").alias("r")).select(*keys, "r.*")
    smap = broadcast_dimension(sku_map.select("kind", "component", "region", F.col("sku_id").alias("map_sku")),
                               "sku-map")
    ex = ex.join(smap, ["kind", "component", "region"], "left")
    ex = ex.withColumn("sku_id", F.when(F.col("kind") == "sku", F.col("component")).otherwise(F.col("map_sku")))
    pr = broadcast_dimension(prices.select("sku_id", F.col("list_price").cast(PRICE).alias("lp"),
                                           F.col("account_price").cast(PRICE).alias("ap")), "price-pairs")
    ex = ex.join(pr, "sku_id", "left")
    direct = F.col("kind") == "sku"
    err = (F.when(F.col("kind").isNull(), F.lit(None))
           .when(~direct & F.col("sku_id").isNull(),
                 F.struct(F.col("seq").alias("seq"),
                          F.concat(F.lit("missing sku: "), F.col("kind"), F.lit(" "), F.col("component"),
                                   F.lit(" in "), F.coalesce(F.col("region"), F.lit("NULL"))).alias("msg")))
           .when(direct & F.col("lp").isNull(),
                 F.struct(F.col("seq").alias("seq"), F.concat(F.lit("missing list price: "), F.col("sku_id")).alias("msg")))
           .when(direct & F.col("ap").isNull(),
                 F.struct((F.col("seq") + 1).alias("seq"),
                          F.concat(F.lit("missing account price: "), F.col("sku_id")).alias("msg"))))
    zero = F.lit(0).cast(PRICE)
    fee_l = F.coalesce(F.col("lp"), zero) * F.col("qty")
    fee_a = F.coalesce(F.col("ap"), zero) * F.col("qty")
    aggs = [F.min(err).alias("first_error")]
    for term, _ in TERMS:
        aggs.append(F.sum(F.when(F.col("term") == term, fee_l)).alias(f"{term}_list"))
        aggs.append(F.sum(F.when(F.col("term") == term, fee_a)).alias(f"{term}_account"))
    g = ex.groupBy(*keys).agg(*aggs)
    status = F.coalesce(F.col("parse_status"), F.col("first_error.msg"), F.lit(OK))
    ok = status == OK
    cols = []
    for term, _ in TERMS:
        for book in ("list", "account"):
            v = F.round(F.coalesce(F.col(f"{term}_{book}"), F.lit(0)), 2).cast("double")
            cols.append(F.when(ok, v).alias(f"{term}_{book}_price"))
    return g.select(
        *[F.col(c).alias(f"_e_{c}") for c in SPEC_COLUMNS], "instance_type",
        F.lit(CALCULATION_PERIOD).alias("calculation_period"), *cols, status.alias("status"))


def machine_comparison(machine_types: DataFrame, region: str, catalog: DataFrame, sku_map: DataFrame,
                       prices: DataFrame) -> DataFrame:
    """Per machine type in one region: on-demand list, on-demand account, 3-year account."""
    specs = machine_types.select(
        F.col("machine_definition").alias("machine_type"), "machine_definition",
        F.lit(None).cast("string").alias("disk_definition"), F.lit(region).alias("region"))
    est = fleet_estimate(specs, catalog, sku_map, prices, id_col="machine_type")
    return est.select("machine_type", "ondemand_list_price", "ondemand_account_price",
                      "cud_3y_account_price", "status")


def estimate_json(estimate: DataFrame, id_col: str = "spec_id") -> DataFrame:
    """Each estimate row as one nested JSON object: on-demand / 1-year / 3-year blocks with list
    and account price, region, instance type, disk spec, calculation period and status."""
    def block(term: str) -> Column:
        return F.struct(F.col(f"{term}_list_price").alias("list_price"),
                        F.col(f"{term}_account_price").alias("account_price"))

    body = F.struct(block("ondemand").alias("ondemand"), block("cud_1y").alias("1cud"),
                    block("cud_3y").alias("3cud"), "region", "instance_type", "disk_type",
                    "calculation_period", "status")
    return estimate.select(id_col, F.to_json(body, {"ignoreNullFields": "false"}).alias("result"))
