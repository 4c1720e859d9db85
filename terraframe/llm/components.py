"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge, root being the smallest node reachable.

    ``edges`` has two columns of one integer type, ``a`` and ``b``. Each round links the larger neighbours of every
    node to its smallest neighbour, then the smaller ones, until nothing changes; the number of rounds grows with
    the logarithm of the graph's size. Rounds are written tables, and only their counts reach the driver.
    """
    links = settle(edges.select("a", "b").where("a <> b").distinct(), "components")
    state = _state(links)
    while state[0]:
        links = settle(_small_star(_large_star(links)), "components")
        before, state = state, _state(links)
        if state == before:
            break
    # Every node now points at its root alone; roots point at themselves.
    roots = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(links: DataFrame) -> tuple:
    both = F.xxhash64(F.greatest("a", "b"), F.least("a", "b"))
    return tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(both), F.lit(0)), F.coalesce(F.sum(F.pmod(both, F.lit(1 << 31))), F.lit(0))).first())


def _nearest(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the smallest of u and its partners as m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    pairs = pairs.union(links.select(F.col("b"), F.col("a")))
    return _nearest(pairs).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    near = _nearest(pairs)
    kept = near.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return kept.union(near.select(F.col("u"), F.col("m"))).where("a <> b").distinct()
