"""Connected components of a graph that is too large for one machine.

Alternating star contraction with joins: every edge (u, v), u > v, is replaced by edges to the
smallest neighbour of u, first seen from both ends, then only from the larger end.  Minima
combine on the map side and hot nodes are split by the skew join, so a star with a third of
all nodes is no single task.  The number of rounds grows with the logarithm of the longest
path.  Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node move to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node itself, move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u > v").unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node of (u, v) edges.

    Null ends and loops are ignored.  Nodes of any one orderable type.
    """
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = edges.dropna(subset=["u", "v"]).select(u, v).where("u > v").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        edges = stored(_small_star(stored(_large_star(edges).distinct(), "large")).distinct(), "small")
        # Stars only: no centre has a centre of its own, and nothing moves any more.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
