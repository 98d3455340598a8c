"""Connected components of an edge table, as alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import release, store

#: A node with more than edges / HUBS edges (and LEAST at least) is a hub; there are at most 2 * HUBS of them.
HUBS, LEAST = 200, 50


def _with_least(edges: DataFrame, least: DataFrame, limit: int) -> DataFrame:
    """``edges`` (a, b) with ``m`` of ``least`` (a, m, n): hubs by a broadcast of at most 2 * HUBS rows, so that their edges stay
    where they are; the others by a shuffle."""
    hubs = F.broadcast(least.where(F.col("n") > limit).select("a", F.col("m").alias("hub_m")))
    split = edges.join(hubs, "a", "left")
    near = split.where("hub_m is not null").select("a", "b", F.col("hub_m").alias("m"))
    rest = split.where("hub_m is null").select("a", "b").join(least.where(F.col("n") <= limit).select("a", "m"), "a")
    return near.union(rest.select("a", "b", "m"))


def _large_star(edges: DataFrame, limit: int) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    return _with_least(both.where("b > a"), least, limit).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, limit: int) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    others = _with_least(down, least, limit).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), root being the smallest node reachable.

    Steps are partial aggregates and equi-joins. Each round is stored, the round before deleted, and the rounds grow with the
    logarithm of the longest chain. Only a count and a hash per round reach the driver.
    """
    edges = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = _mark(edges)
    while True:
        limit = max(LEAST, mark[0] // HUBS)
        starred = store(_large_star(edges, limit), "starred")
        release(edges)
        edges = store(_small_star(starred, limit), "edges")
        release(starred)
        if (now := _mark(edges)) == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
