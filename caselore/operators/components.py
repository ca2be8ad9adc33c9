"""Connected components of an undirected graph.

Alternating star contraction: every round points the neighbours of a node to the smallest
node around it, which needs a number of rounds that grows with the logarithm of the size and
not with the diameter. A node's smallest neighbour is a minimum, so it is combined before the
shuffle and a hub never gathers its neighbours in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselore.session import shared_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Point all larger neighbours of each node to the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Point the smaller neighbours of each node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter(F.col("u") != F.col("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 60) -> DataFrame:
    """(node, component) for edges (src, dst): the smallest node reached; lone nodes are their own."""
    spark = edges.sparkSession
    shared_dir(spark)
    all_nodes = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    if nodes is not None:
        all_nodes = all_nodes.unionByName(nodes.select("node"))
    all_nodes = all_nodes.distinct()
    state = (edges.filter(F.col("src") != F.col("dst"))
             .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        state = _small_star(_large_star(state)).checkpoint()
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return all_nodes.join(state, all_nodes["node"] == state["u"], "left").select(
        "node", F.coalesce("v", "node").alias("component"))


def merge_components(stored: DataFrame, new_edges: DataFrame) -> DataFrame:
    """(node, component) after new edges (src, dst) arrive, from the stored (node, component) and those edges alone.

    Every stored component is one node, its smallest member, so only edges that the new ones draw between components or
    to new nodes are contracted. The smallest of the smallest members is the smallest node of all, hence the result is that of
    connected_components over all edges. Edges inside a component change nothing; an edge from a node to itself adds the
    node; null end points are left out.
    """
    known = stored.select("node", "component")
    edges = new_edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst").distinct()
    src, dst = known.toDF("src", "src_component"), known.toDF("dst", "dst_component")
    ends = edges.join(src, "src", "left").join(dst, "dst", "left").select(
        F.coalesce("src_component", "src").alias("src"), F.coalesce("dst_component", "dst").alias("dst")).distinct()
    moved = connected_components(ends).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    old = known.join(moved, "component", "left").select("node", F.coalesce("merged", "component").alias("component"))
    added = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(known, "node", "left_anti")
    # a new node is its own component among the contracted ones
    fresh = added.join(moved.withColumnRenamed("component", "node"), "node").select("node", F.col("merged").alias("component"))
    return old.unionByName(fresh)
