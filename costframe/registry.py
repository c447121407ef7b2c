"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one runs a report/catalogue plan over the derived tables of `costframe.fixtures` built from
the whole input tables; the matching DuckDB SQL lives in `costframe.oracle_queries`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costframe import fixtures as fx
from costframe.constants import COMPUTE_SERVICE_ID, DISPLAY_ROW_CAP, REPORT_LAG_DAYS, RESULT_ROW_CAP
from costframe.functions.labels import has_label, lacks_label, no_labels
from costframe.functions.time import la_date
from costframe.plans import compute, daily, estimate, lines, metrics, prices, skumap, spend, storage
from costframe.plans.common import money_to_double
from costframe.plans.prices import first_tier
from costframe.schema import NAT_REPORT
from costframe.session import scratch_path
from costframe.sinks import files as sink_files
from costframe.sinks import tables as sink_tables
from costframe.sources import export_index
from costframe.sources.billing import read_billing_export, union_accounts
from costframe.sources.metrics import read_metric_points
from costframe.sources.ndjson import read_ndjson
from costframe.sources.pricing import newest_snapshot_date

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Report day used by the single-day variants (a day inside the fixture's 91 usage days).
REPORT_DAY = "2024-02-14"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@query("compute_instance_cost")
def q_compute_instance_cost(spark, sf):
    return compute.compute_instance_cost(fx.billing_export(spark, sf))


@query("compute_instance_cost_day")
def q_compute_instance_cost_day(spark, sf):
    return compute.compute_instance_cost(fx.billing_export(spark, sf), target_date=REPORT_DAY)


@query("load_balancer_cost")
def q_load_balancer_cost(spark, sf):
    return compute.load_balancer_cost(fx.billing_export(spark, sf))


@query("other_compute_cost")
def q_other_compute_cost(spark, sf):
    return compute.other_compute_cost(fx.billing_export(spark, sf))


@query("storage_bucket_cost")
def q_storage_bucket_cost(spark, sf):
    return storage.storage_bucket_cost(fx.billing_export(spark, sf))


@query("storage_bucket_cost_by_account")
def q_storage_bucket_cost_by_account(spark, sf):
    return storage.storage_bucket_cost(fx.billing_export(spark, sf), by_account=True)


# ---------------------------------------------------------------------------------------------
# Spend questions over the four account tables (R9-R13) and line-level operators
# ---------------------------------------------------------------------------------------------


# A usage range that covers every fixture day (whole-table questions).
FULL_RANGE = ("2023-12-01", "2024-04-30")
FEB_RANGE = ("2024-02-01", "2024-02-29")
MONTH = "202402"
MONTHS = ("202312", "202404")
BUCKET_FRAGMENT = "bkt-1"
LB_NAME = "fr-3"


@query("account_union")
def q_account_union(spark, sf):
    u = union_accounts(fx.account_tables(spark, sf))
    return lines.summarize(u, F.col("billing_account_id"))


@query("partition_padded_scan")
def q_partition_padded_scan(spark, sf):
    df = spend.scoped_lines(fx.account_tables(spark, sf), start=FEB_RANGE[0], end=FEB_RANGE[1])
    return lines.summarize(df, la_date("usage_start_time").alias("usage_date"))


@query("spend_total_month")
def q_spend_total_month(spark, sf):
    return spend.spend_total_month(fx.account_tables(spark, sf), MONTH)


@query("spend_by_cost_mode")
def q_spend_by_cost_mode(spark, sf):
    return spend.spend_by_cost_mode(fx.account_tables(spark, sf), [F.col("invoice.month").alias("invoice_month")],
                                    invoice_month=MONTHS[0], invoice_month_end=MONTHS[1])


@query("top_services")
def q_top_services(spark, sf):
    return spend.top_services(fx.account_tables(spark, sf), *FULL_RANGE, cost_mode="all_credits", n=5)


@query("top_projects_for_service")
def q_top_projects_for_service(spark, sf):
    return spend.top_projects_for_service(fx.account_tables(spark, sf), COMPUTE_SERVICE_ID, *FULL_RANGE,
                                          cost_mode="credits_no_promotions", n=5)


@query("bucket_cost")
def q_bucket_cost(spark, sf):
    return spend.bucket_cost(fx.account_tables(spark, sf), BUCKET_FRAGMENT, *FULL_RANGE, cost_mode="raw")


@query("lb_cost_by_name")
def q_lb_cost_by_name(spark, sf):
    return spend.lb_cost_by_name(fx.account_tables(spark, sf), LB_NAME, *FULL_RANGE, cost_mode="all_credits")


@query("net_cost_lines")
def q_net_cost_lines(spark, sf):
    return lines.net_cost_lines(fx.billing_export(spark, sf))


@query("label_presence")
def q_label_presence(spark, sf):
    be = fx.billing_export(spark, sf).filter(has_label("forwarding-rule-name"))
    return lines.summarize(be, la_date("usage_start_time").alias("usage_date"))


@query("label_absence")
def q_label_absence(spark, sf):
    be = fx.billing_export(spark, sf).filter(lacks_label("forwarding-rule-name"))
    return lines.summarize(be, F.col("service.id").alias("service_id"))


@query("unlabelled_lines")
def q_unlabelled_lines(spark, sf):
    be = fx.billing_export(spark, sf).filter(no_labels())
    return lines.summarize(be, F.col("service.id").alias("service_id"))


@query("compute_category_counts")
def q_compute_category_counts(spark, sf):
    return lines.compute_category_counts(fx.billing_export(spark, sf))


@query("storage_category_counts")
def q_storage_category_counts(spark, sf):
    return lines.storage_category_counts(fx.billing_export(spark, sf))


@query("usage_month_scaled")
def q_usage_month_scaled(spark, sf):
    return lines.usage_month_scaled(fx.billing_export(spark, sf))


# ---------------------------------------------------------------------------------------------
# Price catalogue (X1-X4), disk prices (R7), fleet estimates (R6) and comparisons
# ---------------------------------------------------------------------------------------------

COMPARISON_REGION = "us-east4"


def _sku_map(spark, sf):
    return skumap.sku_region_map(fx.pricing_export(spark, sf), skumap.pattern_table(spark))


def _price_pairs(spark, sf):
    return prices.first_tier_prices(fx.pricing_export(spark, sf))


@query("latest_prices")
def q_latest_prices(spark, sf):
    lp = prices.latest_prices(fx.pricing_export(spark, sf))
    empty = F.array().cast("array<struct<start_usage_amount:decimal(18,6),usd_amount:decimal(18,6)>>")
    return lp.select(
        "sku_id", "sku_description",
        F.size(F.coalesce("list_price.tiered_rates", empty)).cast("bigint").alias("n_list_tiers"),
        F.size(F.coalesce("billing_account_price.tiered_rates", empty)).cast("bigint").alias("n_account_tiers"),
        first_tier("list_price").cast("double").alias("list_price"),
        first_tier("billing_account_price").cast("double").alias("account_price"),
        "pricing_date")


@query("first_tier_prices")
def q_first_tier_prices(spark, sf):
    fp = _price_pairs(spark, sf)
    return fp.select("sku_id", F.col("list_price").cast("double").alias("list_price"),
                     F.col("account_price").cast("double").alias("account_price"))


@query("sku_price_lookup")
def q_sku_price_lookup(spark, sf):
    requested = fx.billing_export(spark, sf).select(F.col("sku.id").alias("sku_id")).distinct()
    return prices.sku_price_lookup(fx.pricing_export(spark, sf), requested)


@query("sku_region_map")
def q_sku_region_map(spark, sf):
    return _sku_map(spark, sf)


@query("disk_prices")
def q_disk_prices(spark, sf):
    return prices.disk_prices(_sku_map(spark, sf), _price_pairs(spark, sf))


@query("fleet_estimate")
def q_fleet_estimate(spark, sf):
    return estimate.fleet_estimate(fx.fleet_specs(spark, sf), fx.machine_catalog(spark),
                                   _sku_map(spark, sf), _price_pairs(spark, sf))


@query("machine_comparison")
def q_machine_comparison(spark, sf):
    machines = fx.fleet_specs(spark, sf).select("machine_definition").distinct()
    return estimate.machine_comparison(machines, COMPARISON_REGION, fx.machine_catalog(spark),
                                       _sku_map(spark, sf), _price_pairs(spark, sf))


# ---------------------------------------------------------------------------------------------
# Monitoring reports (R5, R8) and sinks (K1, K2+S8, K4)
# ---------------------------------------------------------------------------------------------

FIXTURE_DAYS = ("2023-12-31", "2024-03-30")   # every LA usage day of the billing fixture


@query("nat_fee")
def q_nat_fee(spark, sf):
    return metrics.nat_traffic(fx.metric_points(spark, sf), _sku_map(spark, sf), _price_pairs(spark, sf))


@query("object_count")
def q_object_count(spark, sf):
    return metrics.object_count(fx.metric_points(spark, sf), digits=6)   # both engines round the mean at the edge


@query("ndjson_roundtrip")
def q_ndjson_roundtrip(spark, sf):
    """R5 written as NDJSON day files (K2), loaded back with the report schema."""
    root = scratch_path(spark, "nat-ndjson")
    nat = metrics.nat_traffic(fx.metric_points(spark, sf), _sku_map(spark, sf), _price_pairs(spark, sf))
    sink_files.write_ndjson_days(nat, root)
    return read_ndjson(spark, root, NAT_REPORT).select(*NAT_REPORT.fieldNames())


@query("day_replace_table")
def q_day_replace_table(spark, sf):
    """R1 backfilled into a day-partitioned table, one day re-run (idempotent), table read back."""
    path = scratch_path(spark, "compute-report")
    report = compute.compute_instance_cost(fx.billing_export(spark, sf))
    first, last = (dt.date.fromisoformat(d) for d in FIXTURE_DAYS)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    sink_tables.backfill_days(report, path, days)
    day_report = compute.compute_instance_cost(fx.billing_export(spark, sf), target_date=REPORT_DAY)
    sink_tables.replace_day(day_report, path, REPORT_DAY)
    t = sink_tables.read_report_table(spark, path)
    return t.select(*report.columns)


@query("json_rows")
def q_json_rows(spark, sf):
    """First 100 rows of the load-balancer report as JSON objects (decimals as strings)."""
    lb = compute.load_balancer_cost(fx.billing_export(spark, sf), money_as_double=False)
    order = [F.col(c).asc_nulls_first() for c in
             ("billing_name", "invoice_month", "usage_date", "project_id", "forwarding_rule_name")]
    six = [F.col(f.name).cast("decimal(28,6)").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
           for f in lb.schema.fields]   # six places in the text, as the test table has
    return sink_files.rows_to_json(lb.select(*six), order, RESULT_ROW_CAP)


# ---------------------------------------------------------------------------------------------
# Stored inputs and outputs: exports, saved maps, day tables, files
# ---------------------------------------------------------------------------------------------

NAT_DAYS = ("2024-01-03", "2024-01-04")   # two days of the metric points


def _by_day(lines: DataFrame) -> DataFrame:
    """Export of `fx.billing_lines`, dealt out and sorted by export day for a write by this day.

    The narrow rows travel and are sorted; the wide ones are made where they are written. Small days share
    a task, a large one is split over several.
    """
    return fx.as_export(lines.hint("rebalance", "partition_date").sortWithinPartitions("partition_date"))


def _stored_export(spark, sf):
    """The billing export written as an export table has it: partitioned, money as DOUBLE."""
    path = scratch_path(spark, "billing-export")
    be = _by_day(fx.billing_lines(spark, sf)).withColumn("cost", F.col("cost").cast("double"))
    be = be.withColumn("credits", F.transform("credits", lambda c: F.struct(c["type"].alias("type"), c["amount"].cast("double").alias("amount"))))
    be.write.partitionBy("partition_date").parquet(path)
    return read_billing_export(spark, path)


@query("compute_instance_cost_from_export")
def q_compute_instance_cost_from_export(spark, sf):
    return compute.compute_instance_cost(_stored_export(spark, sf))


@query("compute_instance_cost_daily")
def q_compute_instance_cost_daily(spark, sf):
    """R1 for one report day by the scheduled job, over a stored export (older partitions pruned)."""
    path = scratch_path(spark, "compute-daily")
    run_date = (dt.date.fromisoformat(REPORT_DAY) + dt.timedelta(days=REPORT_LAG_DAYS)).isoformat()
    daily.run_billing_report("compute_instance", _stored_export(spark, sf), path, run_date=run_date)
    columns = compute.compute_instance_cost(fx.billing_export(spark, sf)).columns
    return money_to_double(sink_tables.read_report_table(spark, path).select(*columns))


@query("storage_bucket_cost_null_safe")
def q_storage_bucket_cost_null_safe(spark, sf):
    return storage.storage_bucket_cost(fx.billing_export(spark, sf), null_safe=True)


@query("spend_having")
def q_spend_having(spark, sf):
    """Services whose raw cost over all days is above 100 million (HAVING)."""
    return spend.spend(fx.account_tables(spark, sf), "raw", [F.col("service.id").alias("service_id")],
                       having=F.col("cost") > 100_000_000, start=FULL_RANGE[0], end=FULL_RANGE[1])


@query("price_tiers")
def q_price_tiers(spark, sf):
    """Every tier of both price books of the requested SKUs, from the full structs of the lookup."""
    requested = fx.billing_export(spark, sf).select(F.col("sku.id").alias("sku_id")).distinct()
    full = prices.sku_price_lookup(fx.pricing_export(spark, sf), requested, flatten=False)
    books = F.array(*[F.struct(F.lit(n).alias("book"), F.col(f"{b}.tiered_rates").alias("tiers"))
                      for n, b in (("list", "list_price"), ("account", "billing_account_price"))])
    rows = full.select("sku_id", F.inline(books))
    return rows.select("sku_id", "book", F.posexplode("tiers").alias("tier", "t")).select(
        "sku_id", "book", F.col("tier").cast("bigint").alias("tier"), F.col("t.start_usage_amount").cast("double").alias("start_usage"),
        F.col("t.usd_amount").cast("double").alias("usd"))


@query("fleet_estimate_saved_map")
def q_fleet_estimate_saved_map(spark, sf):
    """R6 with the SKU map written out by kind and loaded again."""
    path = scratch_path(spark, "sku-map")
    sink_files.write_sku_map(_sku_map(spark, sf), path)
    return estimate.fleet_estimate(fx.fleet_specs(spark, sf), fx.machine_catalog(spark),
                                   sink_files.read_sku_map(spark, path), _price_pairs(spark, sf))


@query("comparison_csv")
def q_comparison_csv(spark, sf):
    """R14 written as CSV and read back."""
    path = scratch_path(spark, "comparison-csv")
    report = q_machine_comparison(spark, sf)
    sink_files.write_csv(report, path)
    return spark.read.schema(report.schema).option("header", "true").csv(path)


@query("display_rows")
def q_display_rows(spark, sf):
    """The rows shown of the load-balancer report."""
    lb = compute.load_balancer_cost(fx.billing_export(spark, sf))
    order = [F.col(c).asc_nulls_first() for c in
             ("billing_name", "invoice_month", "usage_date", "project_id", "forwarding_rule_name")]
    return sink_files.display_rows(lb, order, DISPLAY_ROW_CAP)


@query("nat_day_replace")
def q_nat_day_replace(spark, sf):
    """R5's daily job for two days, then the first day again without points: only the second stays."""
    files, table = scratch_path(spark, "nat-files"), scratch_path(spark, "nat-table")
    points, pairs = fx.metric_points(spark, sf), _price_pairs(spark, sf)
    smap = _sku_map(spark, sf)
    run_dates = [(dt.date.fromisoformat(d) + dt.timedelta(days=REPORT_LAG_DAYS)).isoformat() for d in NAT_DAYS]
    for run_date in run_dates:
        daily.run_nat_report(points, smap, pairs, files, table, run_date=run_date)
    daily.run_nat_report(points.limit(0), smap, pairs, files, table, run_date=run_dates[0])
    return sink_tables.read_report_table(spark, table).select(*NAT_REPORT.fieldNames())


# ---------------------------------------------------------------------------------------------
# Exports with instants, late lines, typed metric values, versioned maps
# ---------------------------------------------------------------------------------------------

LATE_FROM = "2024-03-15"     # export days that arrive with the second delivery
LATE_DAY = "2024-04-20"      # export day of lines that are weeks late
LATE_USAGE = ("2024-01-20", "2024-02-25")   # usage days (UTC) of which a third of the lines is late


def _instant(c) -> F.Column:
    """A UTC wall clock as the instant it names, whatever the session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c))


def _write_export(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """`fx.billing_lines` as an export table stores them: times as instants, one folder per export day."""
    instants = _by_day(lines).withColumns({c: _instant(F.col(c)) for c in ("usage_start_time", "usage_end_time", "export_time")})
    instants.write.mode(mode).partitionBy("partition_date").parquet(path)


@query("compute_instance_cost_from_instants")
def q_compute_instance_cost_from_instants(spark, sf):
    """R1 over an export whose times are TIMESTAMPs."""
    path = scratch_path(spark, "instant-export")
    _write_export(fx.billing_lines(spark, sf), path)
    return compute.compute_instance_cost(read_billing_export(spark, path))


def _late_export(spark, sf, path):
    """Two deliveries of the export: (write the first, write the second)."""
    lines = fx.billing_lines(spark, sf)
    late = (F.to_date(fx.export_column("usage_start_time")).isin([F.lit(d).cast("date") for d in LATE_USAGE])
            & (F.crc32(F.concat_ws("|", fx.export_column("sku")["id"], fx.export_column("cost").cast("string"))) % 3 == 0))
    dealt = lines.withColumn("partition_date", F.when(late, F.lit(LATE_DAY).cast("date")).otherwise(F.col("partition_date")))
    second = F.col("partition_date") >= F.lit(LATE_FROM).cast("date")
    return lambda: _write_export(dealt.where(~second), path), lambda: _write_export(dealt.where(second), path, "append")


@query("late_days_recomputed")
def q_late_days_recomputed(spark, sf):
    """R1's table after two deliveries of an export: the second run recomputes the days it touches."""
    export, index, table = (scratch_path(spark, f"late-{n}") for n in ("export", "index", "table"))
    first, second = _late_export(spark, sf, export)
    first()
    daily.run_late_days(spark, "compute_instance", export, index, table, run_date="2024-05-10")
    second()
    daily.run_late_days(spark, "compute_instance", export, index, table, run_date="2024-05-10")
    columns = compute.compute_instance_cost(fx.billing_export(spark, sf)).columns
    return money_to_double(sink_tables.read_report_table(spark, table).select(*columns))


@query("compute_instance_cost_indexed_day")
def q_compute_instance_cost_indexed_day(spark, sf):
    """R1 of one old day, read only from the export partitions that the index names for it."""
    export, index = (scratch_path(spark, f"indexed-{n}") for n in ("export", "index"))
    _write_export(fx.billing_lines(spark, sf), export)
    change = export_index.changes(spark, export, index)
    export_index.commit(change, index, change.partitions)
    return compute.compute_instance_cost(daily.lines_of_days(spark, export, export_index.read_index(spark, index), [REPORT_DAY]))


def _stored_points(spark, sf):
    """Metric points as the API gives them: whole numbers as INT64, times as instants."""
    path = scratch_path(spark, "metric-points")
    fx.metric_points(spark, sf).withColumns({"value": F.col("value").cast("long"), "ts": _instant(F.col("ts"))}).write.parquet(path)
    return read_metric_points(spark, path)


@query("nat_fee_from_points")
def q_nat_fee_from_points(spark, sf):
    return metrics.nat_traffic(_stored_points(spark, sf), _sku_map(spark, sf), _price_pairs(spark, sf))


@query("object_count_from_points")
def q_object_count_from_points(spark, sf):
    return metrics.object_count(_stored_points(spark, sf), digits=6)


@query("fleet_estimate_versioned_map")
def q_fleet_estimate_versioned_map(spark, sf):
    """R6 with the saved map of its price snapshot, beside maps of an older and a later one."""
    root, pricing = scratch_path(spark, "sku-map-versions"), fx.pricing_export(spark, sf)
    newest = newest_snapshot_date(pricing)
    smap = _sku_map(spark, sf)
    wrong = smap.withColumn("sku_id", F.concat(F.lit("OLD-"), "sku_id"))
    for offset, version in ((-1, wrong), (0, wrong), (0, smap), (1, wrong)):
        sink_files.write_sku_map_version(version, root, newest + dt.timedelta(days=offset))
    return estimate.fleet_estimate(fx.fleet_specs(spark, sf), fx.machine_catalog(spark),
                                   sink_files.read_sku_map_version(spark, root, newest), _price_pairs(spark, sf))


@query("storage_bucket_cost_unlisted")
def q_storage_bucket_cost_unlisted(spark, sf):
    return storage.storage_bucket_cost(fx.billing_export(spark, sf), unlisted=True)


@query("storage_bucket_cost_display")
def q_storage_bucket_cost_display(spark, sf):
    """R4 in the order in which it is shown (by storage cost)."""
    return storage.storage_bucket_cost(fx.billing_export(spark, sf), display_order=True)
