"""Stored exports: instants, late lines, the index of export days, swaps cut short, typed metric values, map versions."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe import fixtures as fx
from costframe import oracle_patterns
from costframe.operators.prefix_join import like_join
from costframe.plans import compute, daily, skumap
from costframe.plans.common import days_filter
from costframe.registry import QUERIES, _by_day, _instant, _write_export
from costframe.schema import BILLING_EXPORT, METRIC_POINTS, PRICING_EXPORT
from costframe.session import release_scratch, scratch_path, scratch_scope
from costframe.sinks import tables
from costframe.sinks.files import read_sku_map_version, write_sku_map_version
from costframe.sinks.tables import backfill_days, read_report_table, recover, replace_day
from costframe.sources import export_index
from costframe.sources.billing import read_billing_export
from costframe.sources.conform import conform, utc_clock
from costframe.sources.metrics import read_metric_points
from costframe.sources.pricing import read_pricing_export
from costframe.plans.prices import latest_prices
from helpers import billing_df, line
from tests.conftest import SF0001

DAY = dt.date(2024, 2, 14)


def write_export(spark, rows, path, mode="append"):
    lines = billing_df(spark, rows)
    instants = lines.withColumns({c: _instant(F.col(c)) for c in ("usage_start_time", "usage_end_time", "export_time")})
    instants.write.mode(mode).partitionBy("partition_date").parquet(path)


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def zone(spark):
    """Sets the session zone and puts the old one back."""
    old = spark.conf.get("spark.sql.session.timeZone")
    yield lambda z: spark.conf.set("spark.sql.session.timeZone", z)
    spark.conf.set("spark.sql.session.timeZone", old)


def test_instants_give_one_day_under_every_session_zone(spark, tmp_path, zone):
    path = str(tmp_path / "export")
    # 07:59:59 UTC is still the 13th in the billing zone, 08:00 the 14th; one time lies in the hour that DST repeats
    starts = [dt.datetime(2024, 2, 14, 7, 59, 59), dt.datetime(2024, 2, 14, 8), dt.datetime(2024, 2, 15, 7, 59, 59, 999999),
              dt.datetime(2024, 11, 3, 9, 30), dt.datetime(2024, 11, 3, 8, 30)]
    rows = [line(start=s, cost=str(2 ** i), partition_date=DAY) for i, s in enumerate(starts)]
    write_export(spark, rows, path)
    seen = set()
    for z in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        zone(z)
        export = read_billing_export(spark, path)
        assert export.schema["usage_start_time"].dataType == T.TimestampNTZType()
        day = compute.compute_instance_cost(export, target_date="2024-02-14")
        assert "PushedFilters" in plan_of(day) and "2024-02-14T08:00" in plan_of(day) and "2024-02-15T08:00" in plan_of(day)
        every = compute.compute_instance_cost(export)
        seen.add((day.agg(F.sum("SUBTOTAL")).first()[0], tuple(sorted((str(r.usage_date), r.SUBTOTAL) for r in every.collect()))))
    assert seen == {(6.0, (("2024-02-13", 1.0), ("2024-02-14", 6.0), ("2024-11-03", 24.0)))}


def test_instants_without_a_read_schema_convert_by_the_epoch(spark, zone):
    zone("America/Los_Angeles")
    times = ["2024-11-03 08:30:00", "2024-11-03 09:30:00", "1969-12-31 23:59:59.999999", None]
    ntz = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    back = ntz.select("t", utc_clock(_instant(F.col("t"))).alias("u"))
    assert back.where("not t <=> u").count() == 0
    schema = T.StructType([T.StructField("s", T.StructType([T.StructField("u", T.TimestampNTZType())])),
                           T.StructField("a", T.ArrayType(T.TimestampNTZType()))])
    nested = ntz.select(F.struct(_instant(F.col("t")).alias("u")).alias("s"), F.array(_instant(F.col("t"))).alias("a"), "t")
    out = conform(nested, schema).select("s.u", F.col("a")[0].alias("v"))
    assert [r.u for r in out.collect()] == [r.v for r in out.collect()] == [r.t for r in ntz.collect()]


def test_pricing_date_does_not_shift(spark, tmp_path, zone):
    base = {f.name: None for f in PRICING_EXPORT.fields}
    row = {**base, "sku": ("S", "d"), "service": ("6F81-5844-456A",), "export_time": dt.datetime(2024, 3, 3, 1), "partition_date": dt.date(2024, 3, 3)}
    df = spark.createDataFrame([tuple(row[f.name] for f in PRICING_EXPORT.fields)], PRICING_EXPORT)
    df.withColumn("export_time", _instant(F.col("export_time"))).write.partitionBy("partition_date").parquet(str(tmp_path / "p"))
    for z in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        zone(z)
        assert latest_prices(read_pricing_export(spark, str(tmp_path / "p"))).first().pricing_date == dt.date(2024, 3, 3)


def folders(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("usage_date=")}


def totals(spark, path):
    return {str(r.usage_date): r.total for r in read_report_table(spark, path).groupBy("usage_date").agg(F.sum("SUBTOTAL").alias("total")).collect()}


def test_a_late_line_recomputes_its_day_only(spark, tmp_path):
    export, index, table = (str(tmp_path / n) for n in ("export", "index", "table"))
    days = [DAY + dt.timedelta(days=i) for i in range(-45, 1)]
    write_export(spark, [line(start=dt.datetime(d.year, d.month, d.day, 12), partition_date=d) for d in days], export)
    run = lambda on: daily.run_late_days(spark, "compute_instance", export, index, table, run_date=on)
    assert run("2024-02-16") == [d.isoformat() for d in days]
    before = folders(table)
    assert run("2024-02-16") == [] and folders(table) == before
    late = DAY - dt.timedelta(days=40)
    write_export(spark, [line(start=dt.datetime(late.year, late.month, late.day, 12), cost="5", partition_date=DAY + dt.timedelta(days=1))], export)
    assert run("2024-02-17") == [late.isoformat()]
    after = folders(table)
    assert {d for d in after if after[d] != before[d]} == {f"usage_date={late}"}
    assert totals(spark, table)[late.isoformat()] == Decimal("15")
    # the old day reads its own partition and the late one, none of those between
    known = export_index.read_index(spark, index)
    assert export_index.partitions_of(known, [late]) == [late, DAY + dt.timedelta(days=1)]
    lines = daily.lines_of_days(spark, export, known, [late])
    filters = plan_of(compute.compute_instance_cost(lines)).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert late.isoformat() in filters and (late + dt.timedelta(days=1)).isoformat() not in filters
    assert compute.compute_instance_cost(lines).agg(F.sum("SUBTOTAL")).first()[0] == 15.0


def test_old_days_are_rerun_from_their_partitions(spark, tmp_path):
    """Also with an index that is behind: what came since is scanned, so its lines count."""
    export, index, table = (str(tmp_path / n) for n in ("export", "index", "table"))
    days = [dt.date(2024, 2, d) for d in range(1, 11)]
    write_export(spark, [line(start=dt.datetime(2024, 2, d.day, 12), partition_date=d) for d in days], export)
    daily.run_late_days(spark, "compute_instance", export, index, table, run_date="2024-03-01")
    before = folders(table)
    write_export(spark, [line(start=dt.datetime(2024, 2, 3, 12), cost="5", partition_date=dt.date(2024, 2, 20))], export)
    assert daily.rerun_days(spark, "compute_instance", export, index, table, ["2024-02-03", "2024-02-11"]) == ["2024-02-03", "2024-02-11"]
    after = folders(table)
    assert {d for d in after if after[d] != before[d]} == {"usage_date=2024-02-03"} and totals(spark, table)["2024-02-03"] == Decimal("15")
    assert daily.run_late_days(spark, "compute_instance", export, index, table, run_date="2024-03-01") == ["2024-02-03"]


def test_lines_past_the_report_day_wait_for_their_day(spark, tmp_path):
    export, index, table = (str(tmp_path / n) for n in ("export", "index", "table"))
    rows = [line(start=dt.datetime(2024, 2, 14, 12), partition_date=dt.date(2024, 2, 15)),
            line(start=dt.datetime(2024, 2, 15, 12), cost="7", partition_date=dt.date(2024, 2, 15))]
    write_export(spark, rows, export)
    run = lambda on: daily.run_late_days(spark, "compute_instance", export, index, table, run_date=on)
    assert run("2024-02-16") == ["2024-02-14"]
    assert run("2024-02-17") == ["2024-02-14", "2024-02-15"]
    assert totals(spark, table) == {"2024-02-14": Decimal("10"), "2024-02-15": Decimal("7")}
    assert run("2024-02-18") == []


def test_a_rewritten_or_removed_partition_touches_its_old_days(spark, tmp_path):
    import shutil
    export, index, table = (str(tmp_path / n) for n in ("export", "index", "table"))
    write_export(spark, [line(start=dt.datetime(2024, 2, d, 12), partition_date=dt.date(2024, 2, d)) for d in (10, 11, 12)], export)
    run = lambda: daily.run_late_days(spark, "compute_instance", export, index, table, run_date="2024-03-01")
    run()
    shutil.rmtree(f"{export}/partition_date=2024-02-11")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_export(spark, [line(start=dt.datetime(2024, 2, 13, 12), partition_date=dt.date(2024, 2, 12))], export, "overwrite")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert run() == ["2024-02-11", "2024-02-12", "2024-02-13"]
    assert sorted(totals(spark, table)) == ["2024-02-10", "2024-02-13"]
    assert run() == []


def test_a_failed_run_is_repeated_whole(spark, tmp_path, monkeypatch):
    export, index, table = (str(tmp_path / n) for n in ("export", "index", "table"))
    write_export(spark, [line(start=dt.datetime(2024, 2, 14, 12), partition_date=DAY)], export)
    run = lambda: daily.run_late_days(spark, "compute_instance", export, index, table, run_date="2024-03-01")
    with monkeypatch.context() as m:
        m.setattr(export_index, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            run()
    assert run() == ["2024-02-14"] and totals(spark, table) == {"2024-02-14": Decimal("10")}


def report(spark, costs):
    return spark.createDataFrame([(dt.date.fromisoformat(d), Decimal(c)) for d, c in costs.items()], "usage_date date, SUBTOTAL decimal(38,12)")


def test_a_swap_cut_short_is_finished_by_the_next_run(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    backfill_days(report(spark, {"2024-02-01": "1", "2024-02-02": "2", "2024-02-03": "3"}), table, ["2024-02-01", "2024-02-02", "2024-02-03"])
    put, calls = tables._put, []

    def failing(spark_, new, target):
        calls.append(target)
        if len(calls) == 2:  # between delete and rename of the second day
            fs, p = tables.hadoop_fs(spark_, target)
            fs.delete(p, True)
            raise RuntimeError("lost")
        put(spark_, new, target)

    with monkeypatch.context() as m:
        m.setattr(tables, "_put", failing)
        with pytest.raises(RuntimeError, match="lost"):
            backfill_days(report(spark, {"2024-02-01": "10", "2024-02-02": "20"}), table, ["2024-02-01", "2024-02-02", "2024-02-03"])
    assert sorted(totals(spark, table)) == ["2024-02-01", "2024-02-03"]  # the second day is missing, the third not yet cleared
    recover(spark, table)
    assert totals(spark, table) == {"2024-02-01": Decimal(10), "2024-02-02": Decimal(20)}
    assert sorted(os.listdir(table)) == ["usage_date=2024-02-01", "usage_date=2024-02-02"] or all(not n.startswith(("_staging", "_commit")) for n in os.listdir(table))


def test_orphaned_staging_folders_go(spark, tmp_path):
    table = str(tmp_path / "table")
    replace_day(report(spark, {"2024-02-01": "1"}), table, "2024-02-01")
    report(spark, {"2024-02-02": "9"}).write.partitionBy("usage_date").parquet(f"{table}/_staging-dead")
    (tmp_path / "table" / "_commit-dead.json.part").write_text("{")
    replace_day(report(spark, {"2024-02-03": "3"}), table, "2024-02-03")
    assert not [n for n in os.listdir(table) if n.startswith(("_staging", "_commit"))]
    assert totals(spark, table) == {"2024-02-01": Decimal(1), "2024-02-03": Decimal(3)}


def test_days_filter_joins_runs_of_days(spark):
    days = [DAY, DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=5)]
    times = [(dt.datetime(2024, 2, 14, 8) + dt.timedelta(hours=6 * i),) for i in range(-4, 30)]
    df = spark.createDataFrame(times, "usage_start_time timestamp_ntz")
    got = {r[0] for r in df.where(days_filter(days)).collect()}
    want = {t for (t,) in times if (t - dt.timedelta(hours=8)).date() in days}
    assert got == want and df.where(days_filter([])).count() == 0


def one_day_tables(spark, path, n=20000):
    """Orders and lineitem whose lines fall on one export day."""
    key = (F.col("id") * 2160).cast("long")
    spark.range(n).select(key.alias("o_orderkey"), (F.col("id") % 97).alias("o_custkey")).write.parquet(f"{path}/orders.parquet")
    spark.range(n).select(
        key.alias("l_orderkey"), (F.col("id") * 7919 % 2000).alias("l_partkey"), (F.col("id") * 31 % 100).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        (F.col("id") % 50 + 0.0).alias("l_quantity"), (F.col("id") % 9973 + 0.25).alias("l_extendedprice"),
        F.expr("CASE WHEN id % 5 <> 4 THEN id % 5 * 0.02D END").alias("l_discount"), F.expr("CASE WHEN id % 7 <> 6 THEN id % 7 * 0.02D END").alias("l_tax"),
    ).write.parquet(f"{path}/lineitem.parquet")


def test_a_large_export_day_is_written_by_several_tasks(spark, tmp_path):
    """Narrow rows are dealt out and sorted, not lines as exported."""
    one_day_tables(spark, str(tmp_path))
    lines, path = fx.billing_lines(spark, str(tmp_path)), str(tmp_path / "export")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        _write_export(lines, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    (day,) = [n for n in os.listdir(path) if n.startswith("partition_date")]
    assert len([n for n in os.listdir(f"{path}/{day}") if n.endswith(".parquet")]) > 1
    direct = conform(fx.billing_export(spark, str(tmp_path)), BILLING_EXPORT)
    line_hash = F.xxhash64(F.to_json(F.struct(*direct.columns))).cast("decimal(38,0)")
    total = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(line_hash)).first())
    assert total(read_billing_export(spark, path)) == total(direct) and total(direct)[0] == 20000
    dealt = [p for p in plan_of(_by_day(lines)).split("\n\n") if "REBALANCE" in p]
    assert dealt and not any("labels" in p for p in dealt)


def test_credits_of_a_line_keep_their_order(spark, tmp_path):
    one_day_tables(spark, str(tmp_path), 2000)
    rows = fx.billing_lines(spark, str(tmp_path))
    seen = {tuple(c["type"] for c in r.credits) for r in fx.as_export(rows).select("credits").collect()}
    assert {(), ("PROMOTION",), ("SUSTAINED_USAGE_DISCOUNT",), ("SUSTAINED_USAGE_DISCOUNT", "PROMOTION")} <= seen
    assert not any(t[:1] == ("PROMOTION",) and len(t) > 1 for t in seen)


# --- metric values -------------------------------------------------------------------------------------------

def stored_points(spark, tmp_path, value):
    base = spark.createDataFrame([("m", "r", dt.datetime(2024, 2, 14))], "metric string, resource_type string, ts timestamp_ntz")
    path = str(tmp_path / "points")
    base.select("metric", "resource_type", _instant(F.col("ts")).alias("ts"), F.expr(value).alias("value")).write.mode("overwrite").parquet(path)
    return read_metric_points(spark, path)


@pytest.mark.parametrize("value, want", [
    ("9007199254740992L", 2.0 ** 53), ("CAST(7 AS INT)", 7.0), ("CAST(NULL AS BIGINT)", None), ("1.5D", 1.5), ("CAST(1.25 AS DECIMAL(9,2))", 1.25),
    ("named_struct('int64_value', 12L, 'double_value', CAST(NULL AS DOUBLE))", 12.0),
    ("named_struct('int64_value', CAST(NULL AS BIGINT), 'double_value', 0.5D)", 0.5),
    ("named_struct('distribution_value', named_struct('count', 42L, 'mean', 3D))", 42.0)])
def test_metric_values_become_double(spark, tmp_path, value, want):
    points = stored_points(spark, tmp_path, value)
    assert points.columns == METRIC_POINTS.fieldNames()
    row = points.first()
    assert row.value == want and row.ts == dt.datetime(2024, 2, 14)


@pytest.mark.parametrize("value", ["9007199254740993L", "9223372036854775807L", "CAST(0.1 AS DECIMAL(38,30)) + CAST('1e-25' AS DECIMAL(38,30))"])
def test_metric_values_are_never_rounded(spark, tmp_path, value):
    with pytest.raises(Exception, match="not exact as DOUBLE"):
        stored_points(spark, tmp_path, value).collect()


def test_metric_values_need_a_number(spark, tmp_path):
    with pytest.raises(TypeError):
        stored_points(spark, tmp_path, "'text'")


# --- SKU map versions, patterns, scratch ------------------------------------------------------------------------

def test_map_versions_follow_the_price_snapshot(spark, tmp_path):
    root = str(tmp_path / "maps")
    smap = lambda sku: spark.createDataFrame([("cpu", "c", "r", sku)], "kind string, component string, region string, sku_id string")
    read = lambda d: read_sku_map_version(spark, root, d).first().sku_id
    with pytest.raises(FileNotFoundError):
        read("2024-03-03")
    write_sku_map_version(smap("A"), root, "2024-03-01")
    write_sku_map_version(smap("B"), root, "2024-03-03")
    assert (read("2024-03-01"), read("2024-03-02"), read("2024-03-03"), read("2024-04-01")) == ("A", "A", "B", "B")
    begun = read_sku_map_version(spark, root, "2024-03-03")
    for i in range(8):
        write_sku_map_version(smap(f"B{i}"), root, "2024-03-03")
        if not i:
            assert begun.first().sku_id == "B"  # a reader of the version before can end
    assert read("2024-03-03") == "B7"
    assert len([n for n in os.listdir(f"{root}/snapshot_date=2024-03-03") if n.startswith("version=")]) == 2
    with pytest.raises(FileNotFoundError):
        read("2024-02-01")


def test_pattern_table_is_the_written_wording():
    assert skumap.pattern_rows() == oracle_patterns.wording_rows()


def test_like_join_is_like(spark):
    import re
    patterns = ["abc%", "abc", "%", "", "a%c", "%bc", "a_c%", "abc%d%", "ab\\%c", "ab\\_%", "_bc"]
    lasts = [None, "%d", "%d%", "_%d", ""]
    texts = ["abc", "abcd", "abd", "ab%c", "ab_x", "", None, "xbc", "abc d", "a.c d", "ABC", "d"]

    def like(t, p):
        out, i = "", 0
        while i < len(p):
            if p[i] == "\\":
                i += 1
                out += re.escape(p[i])
            else:
                out += {"%": ".*", "_": "."}.get(p[i], re.escape(p[i]))
            i += 1
        return t is not None and re.fullmatch(out, t, re.S) is not None

    rows = spark.createDataFrame([(t,) for t in texts], "description string")
    pats = spark.createDataFrame([(a, b) for a in patterns for b in lasts], "one string, two string")
    got = sorted(tuple(r) for r in like_join(rows, "description", pats, "one", "two").select("description", "one", "two").fillna("~").collect())
    want = sorted((t, a, b or "~" if b is None else b) for t in texts for a in patterns for b in lasts if like(t, a) and (b is None or like(t, b)))
    assert got == want
    only = sorted(tuple(r) for r in like_join(rows, "description", pats.select("one").distinct(), "one").select("description", "one").collect())
    assert only == sorted((t, a) for t in texts for a in patterns if like(t, a))


def test_no_nested_loop_for_the_sku_map(spark):
    assert "NestedLoop" not in plan_of(QUERIES["sku_region_map"](spark, SF0001)) and "Cartesian" not in plan_of(QUERIES["sku_region_map"](spark, SF0001))


def test_scratch_folders_go_with_their_scope(spark):
    root = os.path.dirname(scratch_path(spark, "probe")).removeprefix("file:")
    before = set(os.listdir(root))
    with scratch_scope(spark):
        kept = QUERIES["fleet_estimate"](spark, SF0001).collect()
        assert set(os.listdir(root)) > before
        with scratch_scope(spark):
            QUERIES["latest_prices"](spark, SF0001).collect()
    assert kept and set(os.listdir(root)) == before
    assert release_scratch(spark, 10 ** 6) == 0
