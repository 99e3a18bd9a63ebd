"""Connected components of a graph given as edges, in a logarithmic number of rounds.

Each round hangs the neighbours of every node under the smallest node in reach, first the larger
ones, then the smaller ones. Only aggregations and joins, so a node with very many
neighbours is split by Spark like any skewed join key; no component is ever gathered. Rounds
are cut by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrain.llm.common import checkpointed

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node in reach) for every node that has an edge in ``edges(a, b)``."""
    edges = edges.where("a != b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct()
    state = None
    for _ in range(MAX_ROUNDS):
        edges = checkpointed(_small_star(_large_star(edges)))
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if found == state:
            leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return leaves.union(edges.select("b", "b").distinct())
        state = found
    raise RuntimeError("the components did not settle")
