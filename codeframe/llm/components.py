"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeframe.llm.tables import dropped, written


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node id reachable, for every node of a link. Self-links and nulls are left out.

    In a step each node learns the smallest id among its neighbours (an aggregate with map-side combine) and its neighbours are
    linked to that id instead (a join that AQE may split where a node has very many neighbours). The links are done when they
    are stars: no centre is linked to a smaller node. Links that are stars already, as those of pivots, take no step; others about the
    logarithm of the longest path. Each step is written to the shared folder, so its lineage is short, and deleted after the next one.
    """
    edges = written(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    for _ in range(rounds):
        if _stars(edges):
            break
        before, edges = edges, written(_small_star(_large_star(edges)), "stars")
        dropped(before)
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    centres = edges.select(F.col("v").alias("node")).distinct()
    parts = written(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component"))), "parts")
    dropped(edges)
    return parts


def _stars(edges: DataFrame) -> bool:
    """Is every larger end linked to one node only, which is no larger end itself?"""
    twice = edges.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    chained = twice.join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return chained.select("u").unionByName(twice.where("lo <> hi").select("u")).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest id of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
