"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepost.llm.common import save


def _both_ways(edges: DataFrame) -> DataFrame:
    pair = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                   F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.explode(pair).alias("e")).select("e.u", "e.v")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of all nodes of ``links`` (``a, b`` longs): the smallest node reached.

    Alternating large-star and small-star steps: every node's larger neighbours, then its smaller
    ones, are linked to the smallest node around it, until the links no longer change. The
    smallest neighbour is an aggregate and meets the links in a join, so a node with very many
    links isn't gathered anywhere. The number of steps grows with the logarithm of the nodes.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = save(edges.distinct(), "links")
    before = None
    while True:
        around = _both_ways(edges)
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = around.filter("v > u").join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b")
        )
        large = large.filter("a <> b").distinct()
        smaller = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smaller, "a")
        small = small.select(F.col("b").alias("x"), "m").unionByName(
            smaller.select(F.col("a").alias("x"), "m")
        )
        edges = save(
            small.filter("x <> m").distinct().select(F.col("x").alias("a"), F.col("m").alias("b")),
            "links",
        )
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        state = tuple(edges.agg(F.count("*"), digest).first())
        if state == before:
            break
        before = state
    edges = edges.filter("a <> b")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
