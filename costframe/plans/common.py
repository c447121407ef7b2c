"""Shared pieces of the report plans: day filters and the money edge cast."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costframe.constants import BILLING_TZ
from costframe.functions.time import la_date


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def utc_bounds(first, last, tz: str = BILLING_TZ) -> tuple[dt.datetime, dt.datetime]:
    """UTC instants [start, end) covering local days first..last in `tz` (naive UTC values)."""
    z = ZoneInfo(tz)
    a = dt.datetime.combine(_as_date(first), dt.time(), z).astimezone(dt.timezone.utc)
    b = dt.datetime.combine(_as_date(last) + dt.timedelta(days=1), dt.time(), z).astimezone(dt.timezone.utc)
    return a.replace(tzinfo=None), b.replace(tzinfo=None)


def local_day_filter(first, last=None, ts: str = "usage_start_time", tz: str = BILLING_TZ,
                     exact: bool = False) -> Column:
    """Billing-zone day of `ts` within [first, last] (last defaults to first).

    Expressed as the equivalent UTC instant range [local midnight of first, local midnight after
    last) on the raw column: a plain comparison, so it reaches the parquet scan as a pushed filter
    (row-group skipping) and costs no time-zone conversion per row. `exact=True` adds the
    per-row day test as well (same result; for zones whose midnight can fall in a DST gap).
    """
    last = first if last is None else last
    lo, hi = utc_bounds(first, last, tz)
    raw = F.col(ts)
    # string -> TIMESTAMP_NTZ casts involve no time zone (a Python datetime literal would be read
    # in the driver process's zone and then shifted by the session zone)
    cond = ((raw >= F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"))
            & (raw < F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")))
    if exact:
        cond = cond & la_date(ts, tz).between(F.lit(_as_date(first)), F.lit(_as_date(last)))
    return cond


def days_filter(days, ts: str = "usage_start_time", tz: str = BILLING_TZ) -> Column:
    """Billing-zone day of `ts` among `days`: one UTC range for every run of consecutive days."""
    runs: list[list[dt.date]] = []
    for d in sorted({_as_date(d) for d in days}):
        if runs and (d - runs[-1][1]).days == 1:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    out = F.lit(False)
    for first, last in runs:
        cond = local_day_filter(first, last, ts=ts, tz=tz)
        out = cond if len(runs) == 1 else out | cond
    return out


def partition_pad_filter(first, last=None, pad_days: int | None = None,
                         column: str = "partition_date") -> Column | None:
    """Optional partition filter: export day within [first - pad, last + pad]."""
    if pad_days is None:
        return None
    last = first if last is None else last
    lo = _as_date(first) - dt.timedelta(days=pad_days)
    hi = _as_date(last) + dt.timedelta(days=pad_days)
    return F.col(column).between(F.lit(lo), F.lit(hi))


def apply_day_filters(df: DataFrame, target_date=None, date_range=None, pad_days: int | None = None) -> DataFrame:
    """Report day selection: one day, a range, or (both None) every day in the table."""
    if target_date is not None and date_range is not None:
        raise ValueError("give target_date or date_range, not both")
    if target_date is not None:
        date_range = (target_date, target_date)
    if date_range is None:
        return df
    first, last = date_range
    out = df.filter(local_day_filter(first, last))
    pf = partition_pad_filter(first, last, pad_days)
    return out if pf is None else out.filter(pf)


def money_to_double(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (the output edge; sums before it were exact)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields])


def default_run_date(run_date=None, lag_days: int = 2) -> dt.date:
    """Report day for a run: run date minus the export lag (today when not given)."""
    base = _as_date(run_date) if run_date is not None else dt.date.today()
    return base - dt.timedelta(days=lag_days)
