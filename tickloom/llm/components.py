"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import checkpointed

MAX_ROUNDS = 100


def _oriented(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct edges as (u, v) with u > v."""
    high, low = F.greatest(a, b), F.least(a, b)
    return edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    return _oriented(larger.join(least, "u"), "v", "m")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select("v", "m")
    return _oriented(moved.unionByName(least.select(F.col("u").alias("v"), "m")), "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node reachable.

    ``edges`` has columns (a, b) of one integer type. Each round is written to the shared
    folder. Rounds end when the edges no longer change: then each is (node, root). Groups are
    joined to their minimum, never collected, so a node may have any number of edges.
    """
    now = checkpointed(_oriented(edges, "a", "b"))
    before = None
    for _ in range(MAX_ROUNDS):
        row = F.xxhash64("u", "v")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(row), F.sum(F.shiftright(row, 24))).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = checkpointed(_small_star(_large_star(now)))
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
