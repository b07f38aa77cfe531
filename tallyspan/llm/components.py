"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u of ``edges`` (u, v), v < u, has one v alone, and is no other's v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("under"), F.lit(0).alias("over")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    each = ends.groupBy("node").agg(F.sum("under").alias("under"), F.max("over").alias("over"))
    return each.where("under > 1 or under = 1 and over = 1").agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component: its least node.

    Alternating stars: each round hangs a node's larger neighbours, then its smaller
    ones, onto its least neighbour, with the links of a node as rows of a shuffle and
    never gathered. Rounds grow with the logarithm of the longest path, and links that are
    stars already take none. Links to itself, repeated links and links given both ways
    change nothing; links with a null end are ignored; without links there are no rows.
    """
    edges = cut(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(most_rounds):
        if _are_stars(edges):
            break
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        least = least.withColumn("low", F.least("u", "low"))
        # Larger neighbours go to the least one of the neighbourhood.
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # Smaller neighbours go to the least one, and so does the node itself.
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(
            F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()
        edges = cut(small)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(nodes.select("component", "component").distinct())


def joined(reached: DataFrame, links: DataFrame) -> DataFrame:
    """``reached``, a table of ``components``, with more ``links`` (a, b), whose ends may be new nodes.

    Rounds go over links between components alone, so those known are not found again.
    """
    between = links.join(reached.toDF("a", "ca"), "a", "left").join(reached.toDF("b", "cb"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    moved = cut(components(between).toDF("was", "least"))
    known = reached.join(moved, F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("least", "component").alias("component"))
    new = moved.join(reached, F.col("was") == F.col("node"), "left_anti")
    return cut(known.union(new))
