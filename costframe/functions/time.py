"""Billing calendar: instants are UTC, days are counted in the billing time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costframe.constants import BILLING_TZ


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def la_datetime(ts="usage_start_time", tz: str = BILLING_TZ) -> Column:
    """Wall-clock time in `tz` of a UTC instant stored without zone (TIMESTAMP_NTZ).

    `convert_timezone` on an NTZ value ignores the session time zone, so the result does not
    depend on the cluster's `spark.sql.session.timeZone`.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))


def la_date(ts="usage_start_time", tz: str = BILLING_TZ) -> Column:
    """Calendar day in `tz` of a UTC instant."""
    return F.to_date(la_datetime(ts, tz))


def days_in_month(d: Column) -> Column:
    """Number of days in the month of date `d`."""
    return F.dayofmonth(F.last_day(d))


def invoice_month_of(d: Column) -> Column:
    """`YYYYMM` string of a date (the invoice month format)."""
    return F.date_format(d, "yyyyMM")
