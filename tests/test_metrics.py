import datetime as dt
from decimal import Decimal

import pytest

from costframe.constants import NAT_RECEIVED_METRIC, NAT_SENT_METRIC, OBJECT_COUNT_METRIC
from costframe.plans import metrics
from costframe.schema import METRIC_POINTS, SKU_MAP

GIB = 2 ** 30


def _pt(metric, project, value, ts=dt.datetime(2024, 1, 10, 20), rtype="gce_instance", inst="vm-1",
        bucket=None, sclass=None, region="r1"):
    return (metric, rtype, project, "gw", region, "psm", inst, "10.0.0.1", bucket, sclass, ts, float(value))


def test_nat_full_outer_and_project_key(spark):
    pts = spark.createDataFrame([
        _pt(NAT_RECEIVED_METRIC, "p1", GIB), _pt(NAT_RECEIVED_METRIC, "p1", GIB),
        _pt(NAT_SENT_METRIC, "p2", 3 * GIB),                 # sent only, same series name in p2
        _pt(NAT_SENT_METRIC, "p1", GIB, ts=dt.datetime(2024, 1, 11, 9)),   # next LA day
    ], METRIC_POINTS)
    smap = spark.createDataFrame([("nat", "nat-data", "r1", "N1")], SKU_MAP)
    pp = spark.createDataFrame([("N1", Decimal("0.5"), Decimal("0.045"))],
                               "sku_id string, list_price decimal(18,6), account_price decimal(18,6)")
    out = {(r.project_id, r.usage_date): r for r in metrics.nat_traffic(pts, smap, pp).collect()}
    a = out[("p1", dt.date(2024, 1, 10))]
    assert (a.received_bytes_count, a.sent_bytes_count) == (2.0, 0.0)
    assert a.nat_fee_usd == pytest.approx(0.045 * 2)
    b = out[("p2", dt.date(2024, 1, 10))]
    assert (b.received_bytes_count, b.sent_bytes_count) == (0.0, 3.0)
    assert out[("p1", dt.date(2024, 1, 11))].sent_bytes_count == 1.0


def test_nat_missing_sku_gives_null_fee(spark):
    pts = spark.createDataFrame([_pt(NAT_RECEIVED_METRIC, "p1", GIB, region="nowhere")], METRIC_POINTS)
    smap = spark.createDataFrame([], SKU_MAP)
    pp = spark.createDataFrame([], "sku_id string, list_price decimal(18,6), account_price decimal(18,6)")
    assert [r.nat_fee_usd for r in metrics.nat_traffic(pts, smap, pp).collect()] == [None]


def test_object_count_is_mean_of_series_means(spark):
    oc = dict(metric=OBJECT_COUNT_METRIC, project="p", rtype="gcs_bucket", bucket="b", sclass="STANDARD")
    pts = spark.createDataFrame([
        _pt(value=10, inst="s1", **oc), _pt(value=20, inst="s1", **oc), _pt(value=30, inst="s1", **oc),
        _pt(value=100, inst="s2", **oc),
    ], METRIC_POINTS)
    out = metrics.object_count(pts).collect()
    # series means 20 and 100 -> 60 (one flat average would give 40)
    assert [r.object_count for r in out] == [60.0]


def test_nat_daily_job_roundtrip(spark, tmp_path):
    from costframe.plans import daily
    from costframe.sinks.tables import read_report_table
    pts = spark.createDataFrame([_pt(NAT_RECEIVED_METRIC, "p1", GIB), _pt(NAT_SENT_METRIC, "p1", GIB)],
                                METRIC_POINTS)
    smap = spark.createDataFrame([("nat", "nat-data", "r1", "N1")], SKU_MAP)
    pp = spark.createDataFrame([("N1", Decimal("0.5"), Decimal("0.045"))],
                               "sku_id string, list_price decimal(18,6), account_price decimal(18,6)")
    day = daily.run_nat_report(pts, smap, pp, str(tmp_path / "nat"), str(tmp_path / "table"), run_date="2024-01-12")
    assert day == "2024-01-10"
    got = read_report_table(spark, str(tmp_path / "table")).collect()
    assert [(r.received_bytes_count, r.sent_bytes_count) for r in got] == [(1.0, 1.0)]
    assert got[0].nat_fee_usd == pytest.approx(0.09)
