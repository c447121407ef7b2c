import os
import tempfile

import pytest
from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.plans import spend
from costframe.sources.billing import read_billing_export, union_accounts
from tests.conftest import SF0001
from tests.helpers import billing_df, line


def test_time_filter_required(spark):
    df = billing_df(spark, [line()])
    with pytest.raises(ValueError):
        spend.spend(df, "raw")
    with pytest.raises(ValueError):
        spend.spend(df, "raw", invoice_month="2024-02")


def test_cost_modes_order(spark):
    tabs = fx.account_tables(spark, SF0001)
    out = {r.cost_mode: r.cost for r in spend.spend_total_month(tabs, "202402").collect()}
    # credits and promotions are negative: raw >= without promotions >= with everything
    assert out["raw"] >= out["credits_no_promotions"] >= out["all_credits"]


def test_union_has_all_accounts(spark):
    tabs = fx.account_tables(spark, SF0001)
    u = union_accounts(tabs)
    assert u.count() == fx.billing_export(spark, SF0001).count()
    assert sorted(r[0] for r in u.select("billing_account_id").distinct().collect()) == [
        "BA-0", "BA-1", "BA-2", "BA-3"]


def test_padding_reaches_every_partitioned_scan(spark):
    root = tempfile.mkdtemp(prefix="costframe-acct-")
    be = fx.billing_export(spark, SF0001)
    paths = []
    for i in range(2):
        p = os.path.join(root, f"acct{i}")
        be.filter(F.col("billing_account_id") == f"BA-{i}").write.partitionBy("partition_date").parquet(p)
        paths.append(p)
    tabs = [read_billing_export(spark, p) for p in paths]
    q = spend.top_services(tabs, "2024-02-01", "2024-02-29")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(partition_date") == 2
    assert "PushedFilters: [IsNotNull(usage_start_time), GreaterThanOrEqual(usage_start_time" in plan
    rows = q.collect()
    assert 0 < len(rows) <= 5 and rows == sorted(rows, key=lambda r: -r.cost)


def test_bucket_fragment_is_literal(spark):
    rows = [line(service="95FF-2EF5-5EA1", resource=(None, "//s/buckets/a_b"), cost="1"),
            line(service="95FF-2EF5-5EA1", resource=(None, "//s/buckets/axb"), cost="2")]
    out = spend.bucket_cost(billing_df(spark, rows), "a_b", "2024-02-01", "2024-02-29").collect()
    assert [(r.bucket_global_name, r.cost) for r in out] == [("//s/buckets/a_b", 1.0)]


def test_where_and_having(spark):
    rows = [line(sku_id="A", cost="1"), line(sku_id="A", cost="2"), line(sku_id="B", cost="10")]
    out = spend.spend(billing_df(spark, rows), "raw", [F.col("sku.id").alias("sku_id")],
                      where=F.col("sku.id") != "X", having=F.col("cost") > 5,
                      start="2024-02-01", end="2024-02-29").collect()
    assert [(r.sku_id, r.cost) for r in out] == [("B", 10.0)]
