"""Pivot over a fixed list of categories as conditional sums (one hash aggregate, no pivot pass)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_pivot_sum(category: str | Column, value: str | Column, categories: Sequence[str],
                    zero_fill: bool = False) -> list[Column]:
    """One `SUM(CASE WHEN category = c THEN value END) AS c` per listed category.

    Groups with no line of a category get NULL (or 0 with `zero_fill`); categories not listed
    are ignored, as in a PIVOT with an explicit IN list.
    """
    cat = F.col(category) if isinstance(category, str) else category
    val = F.col(value) if isinstance(value, str) else value
    out = []
    for c in categories:
        s = F.sum(F.when(cat == F.lit(c), val))
        out.append((F.coalesce(s, F.lit(0)) if zero_fill else s).alias(c))
    return out


def row_total(columns: Sequence[str], zero) -> Column:
    """Sum across DECIMAL columns with NULL treated as `zero`, kept at twelve places."""
    total = None
    for c in columns:
        term = F.coalesce(F.col(c), zero).cast("decimal(37,12)")
        total = term if total is None else (total + term).cast("decimal(37,12)")
    return total
