"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import materialize

MAX_ROUNDS = 40


def _star(neighbours: DataFrame, larger_only: bool) -> DataFrame:
    """(u, v) lists to edges towards each u's least neighbour m: v > u only (large), or all of v and u (small)."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = neighbours.join(least, "u")
    if larger_only:
        return moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long ids to (node, component): the least id reachable. Nodes without edges don't appear.

    A node of many neighbours is a hot key of plain joins with a small side that has one row per key, which adaptive execution can
    split; its minimum is combined before the shuffle. Each round is written to the shared folder.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, larger_only=True).distinct()
        # every edge of `large` points down, so u's smaller neighbours are all that small-star looks at
        edges = materialize(_star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), larger_only=False).distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
