"""costframe: cloud billing analytics as PySpark DataFrame plans.

Layout:
  functions/  column expressions (time zone days, net cost, labels, categories, spec parsing)
  sources/    readers (billing export, account union, price snapshots, metric points, NDJSON)
  operators/  reusable relational building blocks (fixed pivots, size-checked broadcast, two-level means)
  plans/      report and catalogue jobs built from the above
  sinks/      idempotent day-partition writes, NDJSON day files, JSON row export, CSV
"""

from costframe.session import get_spark, scratch_path  # noqa: F401
