"""Inline billing rows for unit tests (schema = the export schema)."""

import datetime as dt
from decimal import Decimal

from costframe.schema import BILLING_EXPORT


def line(account="BA-0", service="6F81-5844-456A", sku_id="SKU-1", desc="N2 Instance Core running in X",
         start=dt.datetime(2024, 2, 14, 12), project=("p1", "Project 1"), labels=(), location="us-east4",
         resource=None, cost="10.00", usage="1", credits=(), month=None, partition_date=None):
    d = Decimal
    return (
        account, (service, "svc"), (sku_id, desc), start, start + dt.timedelta(hours=1),
        project if project is None else tuple(project),
        None if labels is None else [tuple(kv) for kv in labels], [], (location,),
        resource, [], start, None if cost is None else d(cost), "USD", d(1),
        (d(usage),), None if credits is None else [(t, None if a is None else d(a)) for t, a in credits],
        (month or start.strftime("%Y%m"),), "regular", None, None, None, None, None, None,
        partition_date or start.date(),
    )


def billing_df(spark, rows):
    return spark.createDataFrame(rows, BILLING_EXPORT)
