"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import materialize


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node, to the smallest of them."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; ``root`` is the smallest node of its component.

    ``edges`` has two long columns ``u``, ``v``; nulls and loops are ignored,
    repeated and reversed edges are allowed.  Only minima are aggregated per
    node (map-side combined), so a hub costs no collected neighbour list.  The
    rounds, about log2 of the longest path, are cut by tables in the shared
    checkpoint folder; the driver sees one pair of numbers a round.
    """
    e = edges.where("u is not null and v is not null and u <> v").distinct()
    e = materialize(e, "edges")
    mark = None
    while True:
        e = materialize(_small_star(_large_star(e)), "edges")
        now = e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    # a fixed point is a forest of stars: every u points at its root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v"), F.col("v")).distinct())
