"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.sources import stage

# Rounds deal out this many edges to a task: a few thousand in as many files as a shuffle has
# partitions would cost a round more in tasks and files than in work.
EDGES_PER_TASK = 100_000


def _large_star(edges: DataFrame, label: str, tasks: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    # the least neighbours are written, so that the join reads two plain exchanges and splits hot nodes
    least = stage(both.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), f"{label}_least")
    found = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return found.distinct().coalesce(tasks)


def _small_star(edges: DataFrame, label: str, tasks: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stage(down.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks), f"{label}_least")
    others = down.join(least, "a").where("b != m").select("b", "m")
    return others.union(least.select("a", "m")).toDF("a", "b").distinct().coalesce(tasks)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``a`` and ``b`` joined by edges become ``node`` and the least node it reaches, ``component``.

    Nodes that are the least of their component, and those without an edge, have no row. Each
    round is written; rounds grow with the logarithm of the longest chain.
    """
    edges = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), label)
    before = _state(edges)
    while before[0]:
        tasks = -(-before[0] // EDGES_PER_TASK)
        edges = stage(_large_star(edges, label, tasks), label)
        edges = stage(_small_star(edges, label, tasks), label)
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
