"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum per node (partial minima before the shuffle) and a join, so a hub with
a third of all edges is summed by many tasks and its join is split by adaptive execution. Each
round is written to the shared folder; nothing is gathered in one task or on the driver but the
count and checksum that tell convergence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.operators.staging import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``(u, v)`` with u > v.

    Large: each node's larger neighbours move to its smallest neighbour (or itself).
    Small: each node's smaller neighbours, and the node itself, move to the smallest of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges`` (u, v) that is not a root itself.

    The root is the smallest node of the component.
    """
    now = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, seen = materialize(now, "stars"), None
    while True:
        print_ = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if print_ == seen or not print_[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = print_
        now = materialize(_star(_star(now, True), False), "stars")
