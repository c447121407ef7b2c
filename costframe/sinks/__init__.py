"""Writers: idempotent day partitions, NDJSON day files, JSON rows, CSV, partitioned SKU map."""

from costframe.sinks.tables import replace_day, backfill_days, read_report_table  # noqa: F401
from costframe.sinks.files import (write_ndjson_days, rows_to_json, display_rows,  # noqa: F401
                                   write_csv, write_sku_map)
