"""Connected components of a graph that is too large for one task.

Alternating large-star and small-star steps, until all edges lead straight to the smallest node;
each round is written to the shared folder and nothing but that test comes to the driver. Minima are pre-aggregated, and
edges meet them by a join that deals out nodes with very many neighbours, so such a node is never one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.common import settle_narrow
from herald.scale import keyed_join


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest ``v`` of every ``u``, written, so that it can be measured."""
    return settle_narrow(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return (keyed_join(both.filter(F.col("v") > F.col("u")), low, ["u"], "inner")
            .select(F.col("m").alias("v"), F.col("v").alias("u")).filter(F.col("u") != F.col("v")))


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    tied = keyed_join(down, low, ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(low.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, and it leads to the smallest node of its component: no
    label is a node that has a label itself."""
    if not edges.groupBy("u").count().filter(F.col("count") > 1).isEmpty():
        return False
    centres = edges.select("v").distinct()
    return centres.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); the label is the smallest node of the
    component. NULL ends are ignored."""
    rows = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    rows = settle_narrow(small_star(rows.filter(F.col("a") != F.col("b"))).distinct(), "edges")
    while not _stars(rows):
        rows = settle_narrow(small_star(large_star(rows)).distinct(), "edges")
    tied = rows.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return tied.unionByName(rows.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
