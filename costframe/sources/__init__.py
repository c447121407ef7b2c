"""Readers. All take explicit schemas; filters given to them reach the parquet scan."""

from costframe.sources.billing import (  # noqa: F401
    read_billing_export, union_accounts, padded_partition_filter,
    invoice_month_filter,
)
from costframe.sources.pricing import read_pricing_export, latest_snapshot  # noqa: F401
from costframe.sources.metrics import read_metric_points  # noqa: F401
from costframe.sources.ndjson import read_ndjson  # noqa: F401
