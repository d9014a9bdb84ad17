"""Connected components by alternating large-star and small-star rounds.

Each half round points every node at the least node of its neighbourhood with one
grouped minimum (combined before the shuffle) and one join; both sides of that join are
written tables, so Spark may split the rows of a node with very many neighbours.  The
edges end as stars around each component's least node.  Nothing but a count and a
checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import common


def half(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Large star over (u, v) both ways, or small star over edges with v < u."""
    least = common.written(edges.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    near = edges.join(least, "u")
    if both_ways:
        near = near.select(F.col("v").alias("u"), F.least("m", "u").alias("v"), (F.col("v") > F.col("u")).alias("ok")).where("ok and u <> v")
    else:
        # every other neighbour, and u itself (from the row that holds the least one)
        near = near.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return common.written(near.select("u", "v").distinct(), "star")


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str, node: str = "node", root: str = "root") -> DataFrame:
    """(node, root) of every node of `edges` but the roots themselves; the root is the
    least node of the component.  Null ends and loops are ignored."""
    now = common.written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    before = signature(now)
    while before[0]:
        wide = half(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), True)
        now = half(wide, False)
        after = signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias(node), F.col("v").alias(root))
