"""Connected components of an edge table, by large-star and small-star
steps: every step only takes minima by vertex and joins them back, so no
vertex's neighbours are ever gathered in one place."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


#: Edges of one partition while a step runs: small edge tables are not spread
#: over many tasks.
PART_EDGES = 20_000


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """``vertex, component``: for every vertex of ``edges`` (``a, b``, longs)
    that is not the smallest of its component, that smallest vertex."""
    def clean(e: DataFrame, parts: int) -> DataFrame:
        return checkpointed(e.filter("a <> b").coalesce(parts).distinct().coalesce(parts))

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    edges = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .filter("a <> b").distinct())
    seen = mark(edges)
    for _ in range(limit):
        if not seen[0]:
            break
        parts = max(1, math.ceil(seen[0] / PART_EDGES))
        edges = clean(_small_star(_large_star(edges.coalesce(parts)).coalesce(parts)), parts)
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        seen = now
    if seen[0]:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
