"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """The larger neighbours of each node move to the smallest of the node and its neighbours."""
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near"))
    both = both.union(edges.select(F.col("lo").alias("node"), F.col("hi").alias("near")))
    least = both.groupBy(F.col("node").alias("lo")).agg(F.least(F.first("node"), F.min("near")).alias("least"))
    # staged, so that both sides of the join are dealt anew and adaptive execution can split a hub's edges
    least = stage(least, "least")
    return edges.join(least, "lo").select("hi", F.col("least").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of each node, and the node, move to the smallest of them."""
    least = stage(edges.groupBy("hi").agg(F.min("lo").alias("least")), "least")
    moved = edges.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.union(least.select("hi", F.col("least").alias("lo"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one smaller node that hangs on none."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select(F.col("lo").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    counts = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return counts.where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for all nodes of ``edges``.

    ``edges`` has long columns ``a`` and ``b``; direction, loops and repeats do not matter.
    Large and small stars alternate until every node hangs on the smallest of its component. No
    step adds edges, and the rounds grow with the square of the logarithm of the nodes at most,
    whatever the order of ids along a chain. Rounds are staged in the shared folder and nothing but
    whether one is left reaches the driver. An empty edge table gives an empty result.
    """
    edges = stage(edges.select("a", "b").distinct(), "links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    stars = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "stars",
    )
    while not _settled(stars):
        stars = stage(_small_star(stage(_large_star(stars), "stars")), "stars")
    labels = nodes.join(stars.select(F.col("hi").alias("node"), "lo"), "node", "left")
    return stage(labels.select("node", F.coalesce("lo", "node").alias("component")), "labels")
