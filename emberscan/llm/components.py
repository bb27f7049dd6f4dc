"""Connected components of an edge table by alternating star operations.

A node's neighbours are never gathered: its least neighbour is a partial
aggregate, joined back to its edges, where adaptive execution splits hot nodes.
Each round is checkpointed; a digest of the edges, one number, tells when
nothing changes. The number of rounds grows with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the least node `m` among a and its neighbours b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(least, "a")


def _pairs(df: DataFrame, a: Column | str, b: Column | str) -> DataFrame:
    return df.select(F.col(a).alias("a"), F.col(b).alias("b")) if isinstance(a, str) else df.select(a, b)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(_pairs(edges, "b", "a"))
    return _pairs(_with_least(both).where("b > a"), "b", "m").where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    linked = _with_least(down)
    return _pairs(linked, "b", "m").union(_pairs(linked, "a", "m")).where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node of an edge table (a, b).

    Loops, repeated edges and either direction are allowed; nodes without an edge do not appear.
    """
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, at = None, _digest(now)
    while at != before:
        now, before = keep(_small_star(_large_star(now))), at
        at = _digest(now)
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select("b", "b")).groupBy("node").agg(F.min("component").alias("component"))
