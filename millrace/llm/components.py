"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

MOST_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionByName(turned)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are hung on the smallest node near it.

    ``large``: greater neighbours of every node; else the smaller ones, with the node itself.
    """
    near = _both_ways(edges) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    hung = near.join(low, "a")
    if large:
        made = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        made = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
    return made.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (a, b); a component is its smallest node.

    Each round is written, so a lost executor repeats one round. Rounds grow with the logarithm
    of the number of nodes.
    """
    edges = stored(edges.select("a", "b").filter(F.col("a") != F.col("b")), "components")
    state = None
    for _ in range(MOST_ROUNDS):
        edges = stored(_star(_star(edges, True), False), "components")
        was, state = state, edges.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b") % (1 << 30)).alias("sum"),
            F.count_distinct("a").alias("nodes"),
        ).first()
        if state["n"] == state["nodes"] and was is not None and tuple(was) == tuple(state):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
