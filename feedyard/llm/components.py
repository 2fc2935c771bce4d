"""Connected components of a graph that is larger than any one machine, by alternating stars."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedyard.session import stable

EDGES_PER_TASK = 5_000  # a round shuffles several times, and each task that writes a shuffle leaves files of its own, however few its edges


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(neighbours: DataFrame) -> DataFrame:
    """Smallest node among each node's neighbours and itself; reduced per task, so a node of any degree is one row each."""
    return neighbours.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``; the root is the smallest node of the component.

    Large star: all larger neighbours of a node move to its smallest neighbour. Small star: all smaller ones do. Each
    round is two aggregates and two joins, is checkpointed, and the number of rounds grows with the logarithm of the
    size of a component. Raises if ``max_rounds`` do not suffice.
    """
    now = stable(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(now)
    for _ in range(max_rounds):
        tasks = 1 + before[0] // EDGES_PER_TASK
        around = _both_ways(now.coalesce(tasks))
        large = around.join(_least(around), "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct().coalesce(tasks)
        around = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = around.groupBy("a").agg(F.min("b").alias("m"))
        small = around.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = stable(small.coalesce(tasks).distinct().coalesce(tasks))
        after = _state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components have not settled")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
