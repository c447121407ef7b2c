import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.plans import estimate, prices, skumap
from costframe.schema import PRICING_EXPORT, SKU_MAP

C = "6F81-5844-456A"


def _price_row(sku, desc, regions, lp, ap, day=dt.date(2024, 3, 3), service=C):
    tier = lambda v: None if v is None else [(Decimal(0), Decimal(v))]
    return ((sku, desc), (service,), (regions,), (tier(lp),), (tier(ap) if ap is not None else [],),
            dt.datetime.combine(day, dt.time(6)), day)


def test_pattern_table_rules():
    rows = skumap.pattern_rows()
    comps = {(k, c) for k, c, _, _ in rows}
    assert ("cpu", "n2-custom") in comps and ("cpu", "a2-custom") not in comps
    assert ("ram", "e2-custom") in comps and ("gpu", "nvidia-b200-cud-3y") in comps
    first = {(k, c): (a, b) for k, c, a, b in rows}
    assert first[("cpu", "n1-cud-1y")] == ("Commitment v1: Cpu in%", "%for 1 Year")
    assert first[("ram", "c2-cud-3y")] == ("Commitment: Compute optimized Ram running in%", "%for 3 Year")
    assert first[("cpu", "c3-cud-3y")][1] == "%for 3 Years"
    assert sum(1 for k, c, _, _ in rows if c == "local-ssd") == 2          # two proper alternatives
    assert all(b in (None, "%for 1 Year", "%for 3 Year%") for *_, b in skumap.pattern_rows(match_plural=True)
               if b is None or "3 Year" in b or "1 Year" in b)


def test_sku_map_regions_and_last_wins(spark):
    rows = [
        _price_row("S1", "N2 Instance Core running in Warsaw", ["europe-west1", "x"], "1", "1"),
        _price_row("S2", "N2 Instance Core running in Delhi", [], "1", "1"),
        _price_row("S3", "N2 Instance Core running in Virginia", ["us-east4"], "1", "1"),
        _price_row("S4", "N2 Instance Core running in Virginia", ["us-east4"], "1", "1"),
        _price_row("S5", "Commitment v1: N2 Cpu in Virginia for 3 Years", ["us-east4"], "1", "1"),
        _price_row("S6", "Commitment v1: N2 Cpu in Virginia for 3 Year", ["us-east4"], "1", "1"),
        _price_row("S7", "N2 Instance Core running in Iowa", ["us-central1"], "1", "1", day=dt.date(2024, 3, 2)),
        _price_row("S8", "n2 instance core running in Iowa", ["us-central1"], "1", "1"),   # LIKE is case-sensitive
    ]
    pricing = spark.createDataFrame(rows, PRICING_EXPORT)
    m = {(r.kind, r.component, r.region): r.sku_id
         for r in skumap.sku_region_map(pricing, skumap.pattern_table(spark)).collect()}
    assert m[("cpu", "n2-predefined", "europe-central2")] == "S1"
    assert ("cpu", "n2-predefined", "europe-west1") not in m
    assert m[("cpu", "n2-predefined", "asia-south2")] == "S2"
    assert m[("cpu", "n2-predefined", "us-east4")] == "S4"
    assert m[("cpu", "n2-cud-3y", "us-east4")] == "S6"          # singular pattern misses "Years"
    assert ("cpu", "n2-predefined", "us-central1") not in m     # older snapshot / lower case
    plural = {(r.component, r.region): r.sku_id for r in
              skumap.sku_region_map(pricing, skumap.pattern_table(spark, match_plural=True)).collect()}
    assert plural[("n2-cud-3y", "us-east4")] == "S6"


def test_first_tier_pairs_and_lookup(spark):
    rows = [_price_row("A", "x", [], "2", "1"), _price_row("B", "y", [], None, "1"),
            _price_row("C", "z", [], None, None)]
    pricing = spark.createDataFrame(rows, PRICING_EXPORT)
    pairs = {r.sku_id: (r.list_price, r.account_price) for r in prices.first_tier_prices(pricing).collect()}
    assert pairs == {"A": (Decimal("2.000000"), Decimal("1.000000")), "B": (None, Decimal("1.000000"))}
    req = spark.createDataFrame([("A",), ("Q",)], "sku_id string")
    out = {r.sku_id: r.error for r in prices.sku_price_lookup(pricing, req).collect()}
    assert out == {"A": None, "Q": "SKU not found"}


def _map(spark, entries):
    return spark.createDataFrame(entries, SKU_MAP)


def _pp(spark, entries):
    return spark.createDataFrame([(s, Decimal(a), Decimal(b)) for s, a, b in entries],
                                 "sku_id string, list_price decimal(18,6), account_price decimal(18,6)")


def test_fleet_estimate_formulas(spark):
    region = "r1"
    smap = []
    for kind in ("cpu", "ram"):
        for comp in ("n2-predefined", "n2-custom", "n2-cud-1y", "n2-cud-3y", "c3-predefined", "c3-cud-1y",
                     "c3-cud-3y", "n1-custom", "n1-cud-1y", "n1-cud-3y"):
            smap.append((kind, comp, region, f"{kind}-{comp}"))
    for comp in ("nvidia-tesla-t4", "nvidia-tesla-t4-cud-1y", "nvidia-tesla-t4-cud-3y"):
        smap.append(("gpu", comp, region, comp))
    for comp in ("pd-standard", "local-ssd", "local-ssd-cud-1y", "local-ssd-cud-3y"):
        smap.append(("disk", comp, region, comp))
    pp = [(s, "0.01", "0.005") for *_, s in smap if s != "ram-n2-cud-3y"]        # no price -> 0
    pp += [("E5BD-12DD-EB30", "0.1", "0.1"), ("3999-11C3-1EE4", "0.2", "0.2")]
    specs = spark.createDataFrame([
        (1, "n2-standard-2", None, region),
        (2, "nvidia-tesla-t4_4_custom-48-163840", "local-ssd-375_pd-standard-100", region),
        (3, "tdx_c3-standard-176", None, region),
        (4, "n2-custom-8-65536-ext", None, region),
        (5, "no-such-type", None, region),
        (6, "n2-standard-2", None, "r2"),
        (7, "n2-standard-2-16lssd", None, region),
    ], "spec_id long, machine_definition string, disk_definition string, region string")
    out = {r.spec_id: r for r in estimate.fleet_estimate(specs, fx.machine_catalog(spark), _map(spark, smap),
                                                         _pp(spark, pp)).collect()}
    # n2-standard-2: 2 vCPU, 8 GiB; 730 h; boot pd-standard 0 GB
    od = 0.01 * 2 * 730 + 0.01 * 8 * 730
    assert out[1].ondemand_list_price == round(od, 2) and out[1].status == "OK"
    assert out[1].cud_3y_list_price == round(0.01 * 2 * 730, 2)      # RAM 3y SKU has no price -> 0
    # custom-48-163840 is n1, 48 vCPU, 160 GiB; 4 T4 GPUs; 100 GB boot; 375 GB local SSD
    r2 = out[2]
    assert r2.instance_type == "nvidia-tesla-t4_4_custom-48-163840"
    assert r2.ondemand_list_price == round(0.01 * (48 * 730 + 160 * 730 + 4 * 730 + 100 + 375), 2)
    # confidential surcharge: on demand and 3-year, not 1-year
    base = 0.01 * (176 + 704) * 730
    conf = (0.1 * 176 + 0.2 * 704) * 730
    assert out[3].ondemand_list_price == round(base + conf, 2)
    assert out[3].cud_1y_list_price == round(base, 2)
    assert out[3].cud_3y_list_price == round(base + conf, 2)
    assert out[3].instance_type == "c3-standard-176"
    assert out[4].status == "invalid custom machine type" and out[4].ondemand_list_price is None
    assert out[5].status == "unknown machine type"
    assert out[6].status == "missing sku: cpu n2-predefined in r2"
    assert out[7].status == "OK" and out[7].instance_type == "n2-standard-2-16lssd"


def test_spec_parser_branches(spark):
    from costframe.plans.estimate import parse_specs
    cat = spark.createDataFrame([], "machine_type string, family string, cpu double, ram_gb double")
    from costframe.operators.local import local_table
    from costframe.schema import MACHINE_CATALOG
    cat = local_table(spark, [("c2d-standard-8", "c2d", 8.0, 32.0), ("g2-standard-8", "g2", 8.0, 32.0)],
                      MACHINE_CATALOG)
    specs = spark.createDataFrame([
        (1, "c2d-standard-8-nps4", None),
        (2, "c2d-standard-8-ssd3t", "pd-balanced-50"),
        (3, "nvidia-l4_2_g2-standard-8", None),
        (4, "nvidia-tesla-t4_4", None),                      # no machine token
        (5, "g2-standard-8", "local-ssd-abc_pd-ssd-10"),     # bad local SSD size
        (6, "e2-custom-4-6144", "local-ssd-375"),            # no boot disk token
        (7, "", None),
    ], "spec_id long, machine_definition string, disk_definition string").withColumn("region", F.lit("r"))
    out = {r.spec_id: r for r in parse_specs(specs, cat).collect()}
    assert (out[1].family, float(out[1].cpu), out[1].parse_status) == ("c2d", 8.0, None)
    assert (out[2].boot_type, out[2].boot_gb, out[2].has_local_ssd, out[2].parse_status) == ("pd-balanced", 50, False, None)
    assert (out[3].gpu_type, out[3].gpu_count, out[3].instance_type) == ("nvidia-l4", 2, "nvidia-l4_2_g2-standard-8")
    assert out[4].parse_status == "invalid machine definition"
    assert out[5].parse_status == "invalid disk definition"
    assert out[6].parse_status == "invalid disk definition"
    assert (out[6].family, float(out[6].cpu), float(out[6].ram_gb)) == ("e2", 4.0, 6.0)
    assert out[7].parse_status == "unknown machine type"


def test_estimate_json_and_struct_lookup(spark):
    import json
    est = spark.createDataFrame(
        [(1, "r", "n2-standard-2", None, "monthly (based on 730 hours)", 1.0, 0.5, 0.9, 0.4, 0.8, 0.3, "OK")],
        "spec_id long, region string, instance_type string, disk_type string, calculation_period string, "
        "ondemand_list_price double, ondemand_account_price double, cud_1y_list_price double, "
        "cud_1y_account_price double, cud_3y_list_price double, cud_3y_account_price double, status string")
    doc = json.loads(estimate.estimate_json(est).collect()[0].result)
    assert doc["ondemand"] == {"list_price": 1.0, "account_price": 0.5}
    assert doc["3cud"]["account_price"] == 0.3 and doc["disk_type"] is None and doc["status"] == "OK"
    pricing = spark.createDataFrame([_price_row("A", "x", [], "2", "1")], PRICING_EXPORT)
    req = spark.createDataFrame([("A",)], "sku_id string")
    row = prices.sku_price_lookup(pricing, req, flatten=False).collect()[0]
    assert row.list_price.tiered_rates[0].usd_amount == Decimal("2.000000") and row.error is None
