import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.constants import COMPUTE_CATEGORIES, STORAGE_NETWORK_COLUMNS
from costframe.functions import lacks_label, net_cost
from costframe.plans import compute, storage
from costframe.sinks import tables
from tests.conftest import SF0001
from tests.helpers import billing_df, line

STO = "95FF-2EF5-5EA1"


def test_r1_invariants(spark):
    be = fx.billing_export(spark, SF0001)
    r1 = compute.compute_instance_cost(be, money_as_double=False)
    total = r1.agg(F.sum("SUBTOTAL")).collect()[0][0]
    lines = be.filter((F.col("service.id") == "6F81-5844-456A") & lacks_label("forwarding-rule-name"))
    expected = lines.agg(F.sum(net_cost())).collect()[0][0]
    assert total == expected
    # pivot columns add up to the subtotal on every row
    bad = r1.filter(sum(F.col(c) for c in COMPUTE_CATEGORIES) != F.col("SUBTOTAL")).count()
    assert bad == 0


def test_r1_groups_and_defaults(spark):
    rows = [
        line(labels=[("instance_name", "vm-1")], cost="1"),
        line(labels=[("instance_name", "vm-1")], desc="N2 Instance Ram", cost="2"),
        line(labels=[], desc=None, cost="4"),                                  # NULL desc -> OTHERS
        line(labels=[("instance_name", "--")], cost="8"),                      # literal '--' stays apart
        line(labels=[("forwarding-rule-name", "fr")], cost="16"),              # goes to R2
        line(labels=[(None, "x")], cost="32"),                                 # NULL key: dropped
    ]
    out = compute.compute_instance_cost(billing_df(spark, rows)).orderBy("SUBTOTAL").collect()
    assert [(r.instance_name, r.SUBTOTAL, r.CPU, r.RAM, r.OTHERS) for r in out] == [
        ("vm-1", 3.0, 1.0, 2.0, 0.0), ("--", 4.0, 0.0, 0.0, 4.0), ("--", 8.0, 8.0, 0.0, 0.0)]
    lb = compute.load_balancer_cost(billing_df(spark, rows)).collect()
    assert [(r.forwarding_rule_name, r.SUBTOTAL_USD) for r in lb] == [("fr", 16.0)]


def test_r1_single_day_uses_billing_zone(spark):
    rows = [line(start=dt.datetime(2024, 2, 14, 7, 59), cost="1"),   # LA 2024-02-13
            line(start=dt.datetime(2024, 2, 14, 8, 0), cost="2")]    # LA 2024-02-14
    out = compute.compute_instance_cost(billing_df(spark, rows), target_date="2024-02-14").collect()
    assert [(r.usage_date, r.SUBTOTAL) for r in out] == [(dt.date(2024, 2, 14), 2.0)]


def test_r3_needs_empty_labels_and_no_category_word(spark):
    rows = [line(desc="Static Ip Charge", labels=[], cost="1"),
            line(desc="Static Ip Charge", labels=None, cost="2"),       # NULL array: not selected
            line(desc="Static Ip Charge", labels=[("a", "b")], cost="4"),
            line(desc=None, labels=[], cost="8"),                       # NULL description: dropped
            line(desc="Local SSD", labels=[], cost="16")]
    out = compute.other_compute_cost(billing_df(spark, rows)).collect()
    assert [(r.description, r.SUBTOTAL) for r in out] == [("Static Ip Charge", 1.0)]


def _sto(**kw):
    kw.setdefault("service", STO)
    return line(**kw)


def test_r4_quirks(spark):
    b = [("bucket_name", "b1")]
    rows = [
        _sto(account="A", desc="Standard Storage US", labels=b, cost="10", usage="2"),
        _sto(account="B", desc="Standard Storage US", labels=b, cost="1", usage="1"),   # same bucket, 2nd account
        _sto(account="A", desc="Download APAC", labels=b, cost="3"),
        _sto(account="A", desc="GCP Storage egress between ME and EU", labels=b, cost="5"),  # unlisted: dropped
        _sto(account="A", desc="Coldline Storage", labels=b, cost="7"),                 # OTHERS
        _sto(account="A", desc="Standard Storage US", labels=[("bucket_name", "b2")], location=None, cost="9"),
    ]
    df = billing_df(spark, rows)
    out = storage.storage_bucket_cost(df).collect()
    b1 = sorted([r for r in out if r.bucket_name == "b1"], key=lambda r: (r.billing_name, r.STORAGE))
    # Q1: join ignores the account -> 2 spine rows x 2 storage rows
    assert len(b1) == 4
    assert {r.Download_APAC for r in b1} == {3.0} and {r.OTHERS for r in b1} == {7.0}
    assert {r.NETWORK_PRICE for r in b1} == {3.0}                       # Q4: ME-EU egress not counted
    feb = 29
    assert sorted({(r.STORAGE, r.USAGE_GB) for r in b1}) == [(1.0, 1.0 * feb), (10.0, 2.0 * feb)]
    # Q3: NULL region keeps the spine row with zero costs
    b2 = [r for r in out if r.bucket_name == "b2"]
    assert [(r.region, r.SUBTOTAL, r.STORAGE_TYPE) for r in b2] == [(None, 0.0, "--")]
    by_acct = storage.storage_bucket_cost(df, by_account=True).collect()
    assert len([r for r in by_acct if r.bucket_name == "b1"]) == 2
    safe = storage.storage_bucket_cost(df, null_safe=True).collect()
    assert [r.SUBTOTAL for r in safe if r.bucket_name == "b2"] == [9.0]
    assert set(STORAGE_NETWORK_COLUMNS) <= set(storage.storage_bucket_cost(df).columns)


def test_day_replace_idempotent_and_empty_day(spark):
    rows = [line(start=dt.datetime(2024, 2, 14, 12), cost="1"), line(start=dt.datetime(2024, 2, 15, 12), cost="2")]
    df = billing_df(spark, rows)
    path = os.path.join(tempfile.mkdtemp(prefix="costframe-k1-"), "t")
    rep = compute.compute_instance_cost(df)
    tables.backfill_days(rep, path, ["2024-02-14", "2024-02-15"])
    once = sorted(tables.read_report_table(spark, path).select("usage_date", "SUBTOTAL").collect())
    tables.replace_day(rep, path, "2024-02-14")
    tables.replace_day(rep, path, "2024-02-14")
    twice = sorted(tables.read_report_table(spark, path).select("usage_date", "SUBTOTAL").collect())
    assert once == twice and len(once) == 2
    # an empty recomputation clears the day (static overwrite)
    tables.replace_day(rep.filter(F.lit(False)), path, "2024-02-15")
    left = tables.read_report_table(spark, path).select("usage_date").collect()
    assert [r.usage_date for r in left] == [dt.date(2024, 2, 14)]
    # a backfill over a range with no rows for a day removes that day too
    tables.backfill_days(rep.filter(F.col("usage_date") == dt.date(2024, 2, 15)), path,
                         ["2024-02-14", "2024-02-15"])
    left = tables.read_report_table(spark, path).select("usage_date").collect()
    assert [r.usage_date for r in left] == [dt.date(2024, 2, 15)]


def test_daily_job_replaces_report_day(spark):
    from costframe.plans import daily
    rows = [line(start=dt.datetime(2024, 2, 14, 12), cost="1"), line(start=dt.datetime(2024, 2, 15, 12), cost="2")]
    path = os.path.join(tempfile.mkdtemp(prefix="costframe-daily-"), "t")
    day = daily.run_billing_report("compute_instance", billing_df(spark, rows), path, run_date="2024-02-16")
    assert day == "2024-02-14"
    got = tables.read_report_table(spark, path).select("usage_date", "SUBTOTAL").collect()
    assert [(r.usage_date, r.SUBTOTAL) for r in got] == [(dt.date(2024, 2, 14), 1.0)]


def test_r4_descriptions_sharing_a_sanitised_name_merge(spark):
    b = [("bucket_name", "b1")]
    rows = [_sto(desc="Standard Storage US", labels=b, cost="1"),
            _sto(desc="Standard Storage, US", labels=b, cost="2"),        # same name after sanitising
            _sto(desc="Nearline Storage Iowa", labels=b, cost="4")]       # second storage type: fan-out
    out = sorted((r.STORAGE_TYPE, r.STORAGE) for r in storage.storage_bucket_cost(billing_df(spark, rows)).collect())
    assert out == [("Nearline_Storage_Iowa", 4.0), ("Standard_Storage_US", 3.0)]
