"""Connected components by alternating large and small stars.

Every round is two aggregations and two joins over the remaining edges, stored
under the checkpoint folder; no node's neighbours are ever gathered in a list, and
the rounds grow with the logarithm of the graph, not with its longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release
from .common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).distinct()
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of an edge, root being the smallest node that
    can be reached. ``edges``: columns a and b, of one integer type; loops and
    repeated edges do no harm; no edges, no rows."""
    now = store(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = _state(now)
    for _ in range(rounds):
        after = store(_small_star(_large_star(now)), "stars")
        release(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
