"""Connected components of an edge table by alternating large and small stars, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeledger.llm import shared


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node of its component.

    Every step lands its edges, and ends when a step changes none. Self edges and repeated edges do no harm.
    """
    now = shared.landed(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(limit):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        step = shared.landed(
            small.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "edges")
        mark, before = _mark(step), mark
        now = step
        if mark == before:
            break
    else:
        raise RuntimeError(f"components are not settled after {limit} steps")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and hash sum of an edge table: equal tables have equal marks, whatever their order."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
