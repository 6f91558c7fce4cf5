"""Connected components of a graph given as links, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.frames import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest reachable node.

    Large stars and small stars in turn: every node hands its greater neighbours,
    then its smaller ones, to the smallest node next to it. The number of links
    never grows, and a long chain halves with every round. What a node needs of
    its neighbours is a minimum, combined before the shuffle; a node with very
    many links is a skewed join, which adaptive execution splits. Each round is
    stored in the shared folder, so lineage stays short. A link from a node to
    itself, or with a null end, links nothing.
    """
    now = written(
        links.where("a <> b").selectExpr("greatest(a, b) AS hi", "least(a, b) AS lo").distinct()
    )
    seen = _mark(now)
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
            .distinct()
        )
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(down, "hi")
            .where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(down.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        now = written(small)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    nodes = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    """The number of links and a sum over their hashes: equal when nothing changed."""
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
    )
