"""Connected components by alternating stars, on DataFrames.

Each round joins every node's larger neighbours to its smallest one, then every
node's smaller neighbours to the smallest of them. Edges never leave Spark. A hub
is met by a partial minimum and a join, whose large partitions Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.common import cut, split_join


def roots(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``; order, repeats and loops don't
    matter, an edge with a null end is none. Without edges the result is empty.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    state = cut(edges.where("a <> b").select(a, b).distinct())
    seen = _mark(state)
    for _ in range(rounds):
        state = cut(_small_star(_large_star(state)))
        now = _mark(state)
        if now == seen:
            stars = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.union(state.select("b", "b").distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _large_star(state: DataFrame) -> DataFrame:
    both = state.union(state.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = split_join(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.where("a <> b").distinct()


def _small_star(state: DataFrame) -> DataFrame:
    least = state.groupBy("a").agg(F.min("b").alias("m"))
    moved = split_join(state, least, ["a"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()


def _mark(state: DataFrame) -> tuple:
    # Equal edge sets give equal marks; a set that settles also keeps its count.
    return tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
