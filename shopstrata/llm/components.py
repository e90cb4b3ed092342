"""Connected components of an edge table, all in joins and grouped minima.

Alternating large and small stars: every round points the larger neighbours of a node, then the
smaller ones, at the least of them. The table shrinks to stars in about log(n)^2 rounds. A node
with many links is pre-aggregated before the shuffle, and its join is left to skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").where("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.distinct()
    hubs = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(hubs, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(hubs.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(a, b)``: the least node it can reach.

    Null ends and loops link nothing. No edges give no rows.
    """
    linked = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = cut(linked.distinct())
    before = _checksum(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        now = cut(_round(now))
        after = _checksum(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
