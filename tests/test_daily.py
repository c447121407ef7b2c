"""Scheduled jobs, scratch folders, and inputs that are not unique."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costframe import session
from costframe.plans import compute, daily, estimate, prices
from costframe.schema import FLEET_SPECS, METRIC_POINTS, PRICING_EXPORT, SKU_MAP
from costframe.sinks.files import display_rows, read_sku_map, rows_to_json, write_sku_map
from costframe.sinks.tables import read_report_table
from helpers import billing_df, line

REGION = "us-east4"


def _points(spark, rows):
    base = {f.name: "x" for f in METRIC_POINTS.fields}
    return spark.createDataFrame([tuple({**base, "metric": "m", **r}[f.name] for f in METRIC_POINTS.fields) for r in rows], METRIC_POINTS)


def test_nat_day_without_points_is_cleared(spark, tmp_path):
    from costframe.constants import GCE_INSTANCE, NAT_RECEIVED_METRIC
    point = {"metric": NAT_RECEIVED_METRIC, "resource_type": GCE_INSTANCE, "region": REGION, "value": float(1 << 30)}
    day, kept = dt.datetime(2024, 2, 14, 20), dt.datetime(2024, 2, 13, 20)
    smap = spark.createDataFrame([("nat", "nat-data", REGION, "N")], SKU_MAP)
    pp = spark.createDataFrame([("N", Decimal("1"), Decimal("2"))], "sku_id string, list_price decimal(18,6), account_price decimal(18,6)")
    files, table = str(tmp_path / "files"), str(tmp_path / "table")

    def run(points, run_date):
        daily.run_nat_report(points, smap, pp, files, table, run_date=run_date)
        return sorted((str(r.usage_date), r.nat_fee_usd) for r in read_report_table(spark, table).collect())

    both = _points(spark, [{**point, "ts": day}, {**point, "ts": kept}])
    run(both, "2024-02-15")
    assert run(both, "2024-02-16") == [("2024-02-13", 2.0), ("2024-02-14", 2.0)]
    assert run(both.where("ts < '2024-02-14'"), "2024-02-16") == [("2024-02-13", 2.0)]


def test_daily_report_prunes_older_exports_and_keeps_late_lines(spark, tmp_path):
    lines = [line(cost="1.00"), line(cost="2.00", partition_date=dt.date(2024, 4, 14)),
             line(cost="4.00", start=dt.datetime(2024, 1, 3, 12))]
    billing_df(spark, lines).write.partitionBy("partition_date").parquet(str(tmp_path / "export"))
    from costframe.sources.billing import read_billing_export
    table = str(tmp_path / "report")
    daily.run_billing_report("compute_instance", read_billing_export(spark, str(tmp_path / "export")), table, run_date="2024-02-16")
    out = read_report_table(spark, table)
    assert out.schema["SUBTOTAL"].dataType.typeName() == "decimal"
    assert sum(r.SUBTOTAL for r in out.collect()) == Decimal("3")
    seen = read_billing_export(spark, str(tmp_path / "export")).filter(F.col("partition_date") >= F.lit(dt.date(2024, 2, 14)))
    plan = compute.compute_instance_cost(seen, target_date="2024-02-14")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "partition_date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_scratch_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master = master

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.checkpoint_root(Session(master))
    assert session.checkpoint_root(Session("local[2]"))


def _price(sku, amount, hour, day=dt.date(2024, 3, 3)):
    book = ([(Decimal(0), Decimal(amount))],)
    return ((sku, "d"), ("6F81-5844-456A",), ([],), book, book, dt.datetime.combine(day, dt.time(hour)), day)


def test_repeated_price_rows_give_one_row(spark):
    pricing = spark.createDataFrame([_price("A", "1", 6), _price("A", "3", 9), _price("A", "2", 7), _price("B", "5", 6)], PRICING_EXPORT)
    want = {"A": Decimal("3"), "B": Decimal("5")}
    pairs = prices.first_tier_prices(pricing).collect()
    assert {r.sku_id: r.list_price for r in pairs} == want and len(pairs) == 2
    asked = spark.createDataFrame([("A",), ("B",), ("C",)], "sku_id string")
    full = prices.sku_price_lookup(pricing, asked, flatten=False)
    rows = {r.sku_id: r for r in full.collect()}
    assert full.count() == 3 and rows["A"].list_price.tiered_rates[0].usd_amount == Decimal("3")
    assert rows["C"].error == prices.SKU_NOT_FOUND


def test_repeated_specs_are_not_summed(spark, tmp_path):
    from costframe import fixtures as fx
    kinds = [(k, c, REGION, f"{k}-{c}") for k in ("cpu", "ram") for c in ("n2-predefined", "n2-cud-1y", "n2-cud-3y")] + [("disk", "pd-standard", REGION, "pd")]
    write_sku_map(spark.createDataFrame(kinds, SKU_MAP), str(tmp_path / "map"))
    smap = read_sku_map(spark, str(tmp_path / "map"))
    pp = spark.createDataFrame([(s, Decimal("0.025288801"), Decimal("0.01")) for *_, s in kinds],
                               "sku_id string, list_price decimal(18,9), account_price decimal(18,9)")
    specs = spark.createDataFrame([(1, "n2-standard-2", None, REGION), (1, "n2-standard-2", None, REGION), (2, "n2-standard-2", None, REGION),
                                   (1, "no-such-type", None, REGION), (3, None, None, None)], FLEET_SPECS)
    out = estimate.fleet_estimate(specs, fx.machine_catalog(spark), smap, pp)
    got = sorted((r.spec_id, r.ondemand_list_price or 0) for r in out.collect())
    two = round(0.025288801 * 10 * 730, 2)
    assert got == [(1, 0), (1, two), (1, two), (2, two), (3, 0)]
    machines = spark.createDataFrame([("n2-standard-2",), ("n2-standard-2",)], "machine_definition string")
    compared = estimate.machine_comparison(machines, REGION, fx.machine_catalog(spark), smap, pp).collect()
    assert [r.ondemand_list_price for r in compared] == [two, two]


def test_row_caps_are_explicit(spark):
    df = spark.range(300)
    assert rows_to_json(df, [F.col("id")], n=None).count() == 300
    assert display_rows(df, [F.col("id")], n=None).count() == 300
    with pytest.raises(TypeError):
        rows_to_json(df, [F.col("id")])


def test_exports_of_any_money_type(spark, tmp_path):
    from costframe.schema import BILLING_EXPORT
    from costframe.sources.billing import read_billing_export
    from costframe.sources.pricing import read_pricing_export
    tiny = [line(cost="0.00")] * 50
    df = billing_df(spark, tiny)
    double = (df.withColumn("cost", F.lit(0.0000004)).withColumn("usage", F.struct(F.lit(0.25).alias("amount_in_pricing_units")))
              .withColumn("credits", F.array(F.struct(F.lit("X").alias("type"), F.lit(-0.0000001).alias("amount"))))
              .withColumn("extra", F.lit(1)).drop("seller_name"))
    double.write.partitionBy("partition_date").parquet(str(tmp_path / "double"))
    got = read_billing_export(spark, str(tmp_path / "double"))
    assert got.columns == BILLING_EXPORT.fieldNames()
    out = compute.compute_instance_cost(got, money_as_double=False).collect()
    assert sum(r.SUBTOTAL for r in out) == Decimal("0.000015")  # 50 x (0.0000004 - 0.0000001)
    df.write.partitionBy("partition_date").parquet(str(tmp_path / "decimal"))
    assert read_billing_export(spark, str(tmp_path / "decimal")).count() == 50
    plan = read_billing_export(spark, str(tmp_path / "decimal")).filter("service.id = 'x' and partition_date > '2024-01-01'").select("cost")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(service.id,x)" in text and "partition_date" in text.split("PartitionFilters")[1].split("]")[0]
    rate = spark.createDataFrame([_price("A", "1", 6)], PRICING_EXPORT)
    tier = "array<struct<start_usage_amount:double,usd_amount:double>>"
    book = F.struct(F.expr(f"CAST(array(struct(0D, 0.0252888D)) AS {tier})").alias("tiered_rates"))
    rate.withColumn("list_price", book).write.partitionBy("partition_date").parquet(str(tmp_path / "pricing"))
    pairs = prices.first_tier_prices(read_pricing_export(spark, str(tmp_path / "pricing"))).collect()
    assert pairs[0].list_price == Decimal("0.0252888") and pairs[0].account_price == Decimal("1")
