"""Connected components of a graph of links, by repeated hooking to smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.tables import durable


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one edge, and is no smaller end: all components are stars."""
    ends = F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return not nodes.where("ups > 1 or ups > 0 and least = 0").count()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it can reach) of every node in a link.

    ``links`` has columns ``a`` and ``b``. Large-star and small-star steps alternate: each
    connects the neighbours of a node to the smallest of them, so that every component ends as a
    star. A step is one aggregation and one join; a node with many neighbours is never gathered
    into one row. Null ends and loops are ignored.
    """
    edges = durable(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while not _stars(edges):
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: larger neighbours move to the smallest neighbour.
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: smaller neighbours, and the node itself, move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = durable(large.join(low, "a").select(F.explode(ends).alias("e")).select("e.*").where("a <> b").distinct())
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
