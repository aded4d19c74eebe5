"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round joins the edges with one row per node, so no task holds a component, and
adaptive execution splits the partition of a node with very many edges.  Rounds are cut to
tables in the shared checkpoint folder; only one number per round reaches the driver.  Every
round costs the driver plans, stages and tasks, so none is run on edges that are stars already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratesmith.session import cut_lineage


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    small = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _open_nodes(edges: DataFrame) -> int:
    """Nodes with two smaller neighbours, or with a smaller and a greater one: 0 if the edges (greater, smaller) are stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where("down > 1 OR down = 1 AND up = 1").count()


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) of every node that has an edge to another; the component is its smallest node.

    ``edges`` has two columns of one orderable type; loops, repeats and nulls are ignored.
    """
    edges = edges.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges, "edges")
    for _ in range(max_rounds):
        if not _open_nodes(edges):
            # every edge now leads from a node to the root of its star
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct())
        edges = cut_lineage(_round(edges), "edges")
    raise RuntimeError("connected components did not settle")
