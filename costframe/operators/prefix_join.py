"""LIKE patterns joined by their literal beginnings instead of one test per pair of rows.

A pattern's head is its text before the first wildcard. A text can match only patterns whose head it
begins with, so each text is joined by equality on its beginnings of the lengths that heads have (a
handful, whatever the number of patterns), and the rest of the pattern is tested on what the join found.
The cost of the join is texts x lengths plus matches, not texts x patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costframe.operators.joins import broadcast_dimension


def like_head(pattern: str) -> Column:
    """Text of a LIKE pattern before its first wildcard or escape."""
    return F.regexp_extract(pattern, r"^[^%_\\]*", 0)


def like_join(rows: DataFrame, text: str, patterns: DataFrame, first: str, last: str | None = None, *, name: str = "patterns") -> DataFrame:
    """Every row with every pattern row that its `text` is LIKE: `first`, and `last` where that is not NULL.

    The columns of both sides are kept; their names must differ. `patterns` is a dimension (see
    `broadcast_dimension`); beyond its bound the join shuffles by beginning.
    """
    heads = patterns.withColumn("_head", like_head(first)).withColumn(
        "_shape", F.when(F.col(first) == F.col("_head"), "whole").when(F.col(first) == F.concat("_head", F.lit("%")), "begin"))
    test = f"CASE _shape WHEN 'whole' THEN {text} = _head WHEN 'begin' THEN true ELSE {text} LIKE {first} END"
    if last is not None:  # LIKE against a column compiles an expression for every pair: not for a plain ending
        heads = heads.withColumn("_end", F.when(F.col(last).rlike(r"^%[^%_\\]+$"), F.substr(last, F.lit(2))))
        test += f" AND ({last} IS NULL OR CASE WHEN _end IS NOT NULL THEN endswith({text}, _end) ELSE {text} LIKE {last} END)"
    lengths = heads.select(F.array_distinct(F.collect_list(F.length("_head")))).scalar()
    begun = (rows.withColumn("_size", F.explode(lengths)).where(F.col("_size") <= F.length(text))
             .withColumn("_begin", F.substr(text, F.lit(1), F.col("_size"))).drop("_size"))
    side = broadcast_dimension(heads, name)
    return begun.join(side, F.col("_begin") == F.col("_head")).where(F.expr(test)).drop("_begin", "_head", "_shape", "_end")
