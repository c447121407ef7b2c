"""Connected components of a link table, by alternating large and small stars.

Links are (a, b) pairs of 64-bit node numbers. A round hangs every node's larger neighbours onto the
smallest node of its neighbourhood, then its smaller ones; the number of rounds grows with the
logarithm of the longest chain. Rounds are written to the shared checkpoint folder, so a lost executor
repeats at most one, and no round gathers a neighbourhood: minima are partial sums, and members meet
their minimum in a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import materialize

MOST_ROUNDS = 60


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star step over (a, b), a > b: every pair of a node's kept neighbours points at the smallest."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = both.join(least, "a")
    if small:
        out = joined.select(F.col("b").alias("x"), "m").unionByName(least.select(F.col("a").alias("x"), "m"))
    else:
        out = joined.where("b > a").select(F.col("b").alias("x"), "m")
    return out.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each linked node's component."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links")
    mark = None
    for _ in range(MOST_ROUNDS):
        edges = materialize(_star(_star(edges, False), True), "component-round")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
