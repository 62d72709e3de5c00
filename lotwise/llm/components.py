"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import keep


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _join_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` with the m of their u from ``least`` (u, m).

    Spark splits a hot key only in a join of two plain shuffles, and an aggregate by u would be joined where
    it is.  A second key that follows from u has ``least``, one row per node, shuffled for the join.
    """
    least = least.select(F.col("u").alias("key"), "m", F.xxhash64("u").alias("key_hash"))
    edges = edges.withColumn("u_hash", F.xxhash64("u"))
    return edges.join(least, (F.col("u") == F.col("key")) & (F.col("u_hash") == F.col("key_hash")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _join_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them; u > v on all edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = _join_least(edges, least).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that it reaches.

    Links may repeat, point either way or from a node to itself; NULL ends are ignored.  Every step is
    written, so a lost executor repeats one step; the driver sees a count and a sum per step.  Minima are
    combined before the shuffle and the joins are skew-splittable, so a node with very many links is fine.
    """
    ends = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = keep(ends, "links")
    before = _state(edges)
    while before[0]:
        edges = keep(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
