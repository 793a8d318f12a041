"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.llm.storage import stage


def components(links: DataFrame) -> DataFrame:
    """The smallest node each node of ``links`` (a, b: long) reaches, as (node, label).

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to its
    smallest neighbour, until each node points straight at its label. A node's smallest neighbour
    is a plain aggregate and comes back by a join, so that a hub's links never meet in one group.
    """
    edges = stage(_oriented(links), "links")
    before = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node ``a`` to the smaller ``b``."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Links from larger neighbours to the smallest node of the neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links from smaller neighbours, and the node itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionByName(least.select("a", F.col("m").alias("b"))))
