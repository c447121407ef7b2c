import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costframe.functions import (compute_category, credits_sum, days_in_month, has_label, la_date,
                                 label_value, lacks_label, net_cost, no_labels, sanitize_name,
                                 storage_category)
from costframe.functions.costs import cost_mode_sums
from tests.helpers import billing_df, line


def _one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_net_cost_null_handling(spark):
    df = billing_df(spark, [
        line(cost="10.00", credits=[("SUSTAINED_USAGE_DISCOUNT", "-1.5"), ("PROMOTION", "-0.5")]),
        line(cost="10.00", credits=None),                       # NULL credits array
        line(cost="10.00", credits=[("X", None)]),              # NULL amount ignored
        line(cost=None, credits=[("X", "-1")]),                 # NULL cost stays NULL
    ])
    assert _one(df, net_cost()) == [Decimal("8.000000"), Decimal("10.000000"), Decimal("10.000000"), None]


def test_credit_types(spark):
    df = billing_df(spark, [line(credits=[("PROMOTION", "-1"), ("SUD", "-2"), (None, "-4")])])
    assert _one(df, credits_sum()) == [Decimal("-7.000000")]
    # NULL type is neither counted as a promotion nor kept by `type <> 'PROMOTION'`
    assert _one(df, credits_sum(exclude_promotions=True)) == [Decimal("-2.000000")]


def test_cost_modes_null_cost_keeps_credits(spark):
    df = billing_df(spark, [line(cost="5", credits=[("PROMOTION", "-1"), ("SUD", "-2")]),
                            line(cost=None, credits=[("SUD", "-3")])])
    got = df.agg(cost_mode_sums("raw").alias("a"), cost_mode_sums("credits_no_promotions").alias("b"),
                 cost_mode_sums("all_credits").alias("c")).collect()[0]
    assert got.a == Decimal("5") and got.b == Decimal("0") and got.c == Decimal("-1")
    with pytest.raises(ValueError):
        cost_mode_sums("net")


def test_label_functions(spark):
    df = billing_df(spark, [
        line(labels=[("instance_name", "vm-1"), ("psm", "a")]),
        line(labels=[]),
        line(labels=None),
        line(labels=[(None, "x")]),
        line(labels=[("psm", "a"), ("psm", "b")]),
        line(labels=[("forwarding-rule-name", "fr-1")]),
    ])
    assert _one(df, label_value("psm")) == ["a", None, None, None, "a", None]
    assert _one(df, has_label("forwarding-rule-name")) == [False, False, None, None, False, True]
    # NOT IN semantics: empty/NULL array -> TRUE; a NULL key with no match -> NULL (row dropped)
    assert _one(df, lacks_label("forwarding-rule-name")) == [True, True, True, None, True, False]
    assert _one(df, no_labels()) == [False, True, None, False, False, False]
    with pytest.raises(Exception):
        df.select(label_value("psm", strict=True)).collect()


def test_compute_category_first_match(spark):
    descs = ["N2 Instance Core running in X", "E2 Instance Ram", "Nvidia GPU", "SSD backed PD Capacity",
             "SSD backed Local Storage", "Storage PD Capacity", "Network Egress", "Static Ip Charge", None,
             "Cpu and Ram"]
    df = spark.createDataFrame([(d,) for d in descs], "d string")
    assert _one(df, compute_category("d")) == ["CPU", "RAM", "GPU", "PD_SSD", "LOCAL_SSD", "PD_HDD",
                                               "NETWORK", "OTHERS", "OTHERS", "CPU"]


def test_storage_category_and_sanitize(spark):
    descs = ["Standard Storage US Multi-region", "Nearline Storage Iowa", "Coldline Storage Iowa",
             "Download Worldwide Destinations (excluding Asia & Australia)",
             "Regional Standard Class A Operations", "Standard Class B Operations Extra",
             "GCP Storage egress between NA and EU", None]
    df = spark.createDataFrame([(d,) for d in descs], "d string")
    assert _one(df, storage_category("d")) == [
        "STORAGE", "STORAGE", "OTHERS", "Download_Worldwide_Destinations_excluding_Asia_Australia",
        "STANDARD_CLASS_A_OPERATIONS", "OTHERS", "GCP_Storage_egress_between_NA_and_EU", "OTHERS"]
    assert _one(df.limit(1), sanitize_name("d")) == ["Standard_Storage_US_Multi_region"]


def test_billing_day_in_los_angeles(spark):
    ts = [dt.datetime(2024, 1, 15, 7, 59), dt.datetime(2024, 1, 15, 8, 0),
          dt.datetime(2024, 3, 10, 7, 59), dt.datetime(2024, 3, 10, 8, 0),   # PST -> PDT that day
          dt.datetime(2024, 3, 11, 6, 59), dt.datetime(2024, 3, 11, 7, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    assert _one(df, la_date("ts")) == [dt.date(2024, 1, 14), dt.date(2024, 1, 15), dt.date(2024, 3, 9),
                                       dt.date(2024, 3, 10), dt.date(2024, 3, 10), dt.date(2024, 3, 11)]
    # independent of the session time zone
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert _one(df, la_date("ts"))[1] == dt.date(2024, 1, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    d = spark.createDataFrame([(dt.date(2024, 2, 14),), (dt.date(2023, 2, 1),)], "d date")
    assert _one(d, days_in_month(F.col("d"))) == [29, 28]


def test_utc_range_equals_local_day_test(spark):
    from costframe.plans.common import local_day_filter
    base = dt.datetime(2024, 3, 8)
    ts = [base + dt.timedelta(minutes=15 * i) for i in range(4 * 24 * 6)]   # across the DST change
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    a = df.filter(local_day_filter("2024-03-09", "2024-03-11", ts="ts")).count()
    b = df.filter(la_date("ts").between(dt.date(2024, 3, 9), dt.date(2024, 3, 11))).count()
    c = df.filter(local_day_filter("2024-03-09", "2024-03-11", ts="ts", exact=True)).count()
    assert a == b == c == (24 * 3 - 1) * 4     # three local days, one of 23 hours


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(2023, 1, 1), max_value=dt.datetime(2025, 12, 31)),
                min_size=1, max_size=200),
       st.dates(min_value=dt.date(2023, 1, 1), max_value=dt.date(2025, 12, 31)),
       st.integers(min_value=0, max_value=40))
def test_utc_range_filter_property(spark, stamps, first, span):
    from costframe.plans.common import local_day_filter
    last = first + dt.timedelta(days=span)
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    a = sorted(r.ts for r in df.filter(local_day_filter(first, last, ts="ts")).collect())
    b = sorted(r.ts for r in df.filter(la_date("ts").between(first, last)).collect())
    assert a == b


def test_day_filter_independent_of_session_zone(spark):
    from costframe.plans.common import local_day_filter
    ts = [dt.datetime(2024, 2, 14, 7, 59), dt.datetime(2024, 2, 14, 8, 0), dt.datetime(2024, 2, 15, 7, 59),
          dt.datetime(2024, 2, 15, 8, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    for zone in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r.ts for r in df.filter(local_day_filter("2024-02-14", ts="ts")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == ts[1:3], zone


_credit = st.tuples(st.sampled_from(["PROMOTION", "SUSTAINED_USAGE_DISCOUNT", None]),
                    st.one_of(st.none(), st.decimals(min_value=-100, max_value=0, places=6)))
_line = st.tuples(st.one_of(st.none(), st.decimals(min_value=0, max_value=10000, places=6)),
                  st.one_of(st.none(), st.lists(_credit, max_size=3)))


@settings(max_examples=5, deadline=None)
@given(st.lists(_line, min_size=1, max_size=30))
def test_cost_modes_property(spark, rows):
    from tests.helpers import billing_df, line
    df = billing_df(spark, [line(cost=None if c is None else str(c),
                                 credits=None if cr is None else [(t, None if a is None else str(a)) for t, a in cr])
                            for c, cr in rows])
    got = df.agg(cost_mode_sums("raw").alias("raw"), cost_mode_sums("credits_no_promotions").alias("np"),
                 cost_mode_sums("all_credits").alias("all"), F.sum(net_cost()).alias("net")).collect()[0]

    def credit_total(cr, keep):
        return sum((a for t, a in (cr or []) if a is not None and keep(t)), Decimal(0))

    costs = [c for c, _ in rows if c is not None]
    raw = sum(costs, Decimal(0)) if costs else None
    exp_np = None if raw is None else raw + sum(credit_total(cr, lambda t: t is not None and t != "PROMOTION")
                                                for _, cr in rows)
    exp_all = None if raw is None else raw + sum(credit_total(cr, lambda t: True) for _, cr in rows)
    nets = [c + credit_total(cr, lambda t: True) for c, cr in rows if c is not None]
    assert got.raw == raw and got.np == exp_np and got["all"] == exp_all
    assert got.net == (sum(nets, Decimal(0)) if nets else None)


def test_credit_sums_pair_one_pass(spark):
    from costframe.functions.costs import credit_sums_pair
    df = billing_df(spark, [line(credits=[("PROMOTION", "-1"), ("SUD", "-2"), (None, "-4"), ("X", None)]),
                            line(credits=None)])
    got = [(r.p["all"], r.p["no_promotions"]) for r in df.select(credit_sums_pair().alias("p")).collect()]
    assert got == [(Decimal("-7.000000"), Decimal("-2.000000")), (Decimal("0.000000"), Decimal("0.000000"))]
