"""Connected components of an undirected graph by alternating star contraction.

Large-star and small-star (Kiveris et al., 2014) replace every neighbourhood by a
star around its smallest member until only stars are left; the number of rounds grows
with the logarithm of the graph. Each star is one shuffle by node, and every round is checkpointed, so a
lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripweave.session import cut


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Connect the larger (or smaller) neighbours of each node to its minimum."""
    pair = lambda u, v: F.struct(u.alias("u"), v.alias("v"))
    u, v = F.col("u"), F.col("v")
    if larger:
        both = F.array(pair(u, v), pair(v, u))
    else:
        both = F.array(pair(F.greatest(u, v), F.least(u, v)))
    # a neighbourhood holds at most every node, and nodes are cells, not points
    rooted = edges.select(F.inline(both)).withColumn("m", F.least(u, F.min(v).over(Window.partitionBy("u"))))
    if larger:
        out = rooted.where(v > u).select(v.alias("u"), F.col("m").alias("v"))
    else:
        out = rooted.select(F.inline(F.array(pair(v, F.col("m")), pair(u, F.col("m")))))
    return out.where(u != v).distinct()


def _settled(edges: DataFrame) -> bool:
    """Every edge leads from a node with no other edge to the root of its star."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up + down > 1 AND up > 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges to (node, root): root is the smallest node of the component.

    Nodes without an edge are not listed; they are their own root.
    """
    current = cut(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _settled(current):
        current = cut(_star(_star(current, True), False))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select("v", F.col("v").alias("r")).distinct()
    )
