"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, store: Scratch, name: str) -> DataFrame:
    """(node, component) for every node with an edge; ``edges`` has bigint columns a and b, any order, loops allowed.

    Each step is a partial aggregate and an equi-join that AQE can split, so a node with many neighbours is no single
    task. Steps are written tables; their number grows with the logarithm of the longest chain.
    """
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    now = store.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")
    seen = state(now)
    turn = 0
    while seen[0]:
        now = store.save(_small_star(_large_star(now)), f"{name}-{turn}")
        turn += 1
        if (after := state(now)) == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
