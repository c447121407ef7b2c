"""Size-checked broadcast.

Dimension tables (price snapshot, SKU map, machine catalogue, pattern table) are broadcast only
when the optimizer's size estimate of their plan is under a bound; beyond it the plain DataFrame
is returned and Spark plans a shuffle join (sort-merge, AQE may still convert it at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of `df`'s plan (no job is run); None when unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(size.toString())
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """`broadcast(df)` when its estimated size is at most `max_bytes`, else `df` unchanged."""
    limit = DEFAULT_MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    size = estimated_size_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


# Parquet file sizes understate the in-memory size of a broadcast relation; count a written
# dimension this many times its file size against the broadcast bound.
PARQUET_EXPANSION = 8


def broadcast_dimension(df: DataFrame, name: str, max_bytes: int | None = None) -> DataFrame:
    """Dimension side of a join with a measured size.

    Fixed tables (VALUES relations) have an exact estimate and are broadcast directly. A derived
    dimension (SKU map, price pairs: bounded by the catalogue, not by usage) has a meaningless
    static estimate after joins, so it is written once to the shared folder; its real file size
    then decides: broadcast under the bound, a plain (sort-merge) join beyond it.
    """
    from costframe.operators.materialize import materialize

    limit = DEFAULT_MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    size = estimated_size_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    written = materialize(df, f"dim-{name}")
    size = estimated_size_bytes(written)
    if size is not None and size * PARQUET_EXPANSION <= limit:
        return F.broadcast(written)
    return written
