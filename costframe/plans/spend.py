"""Spend questions over several account tables.

The rules every such question follows are typed arguments here: a time filter is mandatory
(usage days in the billing zone, or invoice months), each account table is pruned by a padded
partition range, and one of three cost definitions is chosen. Filters are applied above the
union; Catalyst pushes them into every branch's scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.constants import FORWARDING_RULE_PATH, PARTITION_PAD_MONTHS
from costframe.functions.costs import COST_MODES, cost_mode_sums, credit_sums_pair
from costframe.plans.common import local_day_filter, money_to_double
from costframe.sources.billing import (invoice_month_filter, month_bounds, padded_partition_filter,
                                       union_accounts)

Tables = DataFrame | Sequence[DataFrame]


def scoped_lines(tables: Tables, *, start=None, end=None, invoice_month: str | None = None,
                 invoice_month_end: str | None = None, pad_months: int | None = PARTITION_PAD_MONTHS) -> DataFrame:
    """Union of the account tables restricted to a time range (mandatory) plus partition padding.

    `pad_months=None` reads every export partition, so lines exported later than the padding count.
    """
    df = union_accounts(tables if isinstance(tables, (list, tuple)) else [tables])
    if start is not None or end is not None:
        if start is None or end is None:
            raise ValueError("a usage range needs both start and end")
        df = df.filter(local_day_filter(start, end))
        padded = (start, end)
    elif invoice_month is not None:
        first, _ = month_bounds(invoice_month)
        _, last = month_bounds(invoice_month_end or invoice_month)
        df = df.filter(invoice_month_filter(invoice_month, invoice_month_end))
        padded = (first, last)
    else:
        raise ValueError("a time filter is required: usage start/end or invoice month")
    return df if pad_months is None else df.filter(padded_partition_filter(*padded, pad_months))


def spend(tables: Tables, cost_mode: str, group_by: Sequence[Column] = (), where: Column | None = None,
          having: Column | None = None, **scope) -> DataFrame:
    """Cost under `cost_mode` per `group_by` (one row when empty) within the time scope.
    `where` filters lines before the aggregate, `having` filters groups after it (on `cost`)."""
    df = scoped_lines(tables, **scope)
    if where is not None:
        df = df.filter(where)
    out = df.groupBy(*group_by).agg(cost_mode_sums(cost_mode).alias("cost"))
    if having is not None:
        out = out.filter(having)
    return money_to_double(out)


def spend_by_cost_mode(tables: Tables, group_by: Sequence[Column] = (), **scope) -> DataFrame:
    """All three cost definitions in one aggregate, one row per (group, cost_mode)."""
    df = scoped_lines(tables, **scope).withColumn("_credits", credit_sums_pair())
    raw = F.sum("cost")
    agg = df.groupBy(*group_by).agg(
        raw.alias("raw"),
        (raw + F.sum("_credits.no_promotions")).alias("credits_no_promotions"),
        (raw + F.sum("_credits.all")).alias("all_credits"))
    keys = [F.col(c) for c in agg.columns if c not in COST_MODES]
    return money_to_double(agg.unpivot(keys, list(COST_MODES), "cost_mode", "cost"))


def spend_total_month(tables: Tables, invoice_month: str) -> DataFrame:
    """Total spend of an invoice month, one row per cost definition."""
    return spend_by_cost_mode(tables, invoice_month=invoice_month)


def _top(df: DataFrame, key: str, n: int) -> DataFrame:
    # top-n is the feature here; ties broken by the key so the answer is deterministic
    return df.orderBy(F.col("cost").desc_nulls_last(), F.col(key).asc_nulls_last()).limit(n)


def top_services(tables: Tables, start, end, cost_mode: str = "all_credits", n: int = 5) -> DataFrame:
    """The n services with the highest cost in a usage range."""
    df = spend(tables, cost_mode, [F.col("service.id").alias("service_id")], start=start, end=end)
    return _top(df, "service_id", n)


def top_projects_for_service(tables: Tables, service_id: str, start, end,
                             cost_mode: str = "credits_no_promotions", n: int = 5) -> DataFrame:
    """The n projects with the highest cost for one service in a usage range."""
    df = spend(tables, cost_mode, [F.col("project.id").alias("project_id")],
               where=F.col("service.id") == service_id, start=start, end=end)
    return _top(df, "project_id", n)


def bucket_cost(tables: Tables, name_fragment: str, start, end, cost_mode: str = "raw") -> DataFrame:
    """Cost of storage buckets whose resource global name contains a fragment (literal)."""
    return spend(tables, cost_mode, [F.col("resource.global_name").alias("bucket_global_name")],
                 where=F.col("resource.global_name").contains(name_fragment), start=start, end=end)


def lb_cost_by_name(tables: Tables, rule_name: str, start, end, cost_mode: str = "all_credits") -> DataFrame:
    """Cost of one load balancer (forwarding rule) by invoice month."""
    cond = (F.col("resource.name") == rule_name) & F.col("resource.global_name").contains(FORWARDING_RULE_PATH)
    return spend(tables, cost_mode, [F.col("resource.name").alias("forwarding_rule"),
                                     F.col("invoice.month").alias("invoice_month")],
                 where=cond, start=start, end=end)
