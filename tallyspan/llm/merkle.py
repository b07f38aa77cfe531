"""Merkle dataset manifest with incremental witnesses.

Each row is a leaf. Rows of a tree are numbered in order, and an aligned block of
2**levels leaves is appended one by one to open subtrees. An appended leaf starts with an
empty witness; when a sibling completes a subtree, the witnesses of both sides are
extended by the other side's root. A block's root is then a further append, one level of
blocks up, until each tree has one node; its witness extends those of the whole block.

Nodes are lowercase hex SHA-256 of their children's hex texts, one after the other; a node
without a sibling is hashed alone. A witness is kept as ``sides``, a letter for each level
(L: the sibling stands to the left, R: to the right, N: there is none), and ``siblings``,
their digests in a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut, extended, few

LEVELS = 10


def leaf_of(*fields: Column) -> Column:
    """The digest of a row: ``-`` for a null, else the UTF-8 byte count, ``:`` and the value."""
    def said(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(said, fields)), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows``, a table, with number: 0, 1, … in each ``tree`` by ``order``, which must tell rows apart.

    Rows are sorted in ranges, so that no task holds a tree, and numbers go on from range to
    range by their counts, a row for each range and tree.
    """
    dealt = cut(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn(
        "__seq", F.monotonically_increasing_id()), "zstd").withColumn("__range", F.shiftright("__seq", 33))
    counts = dealt.groupBy(tree, "__range").agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(tree).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select(
        tree, "__range", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    return dealt.join(few(offsets, 100_000), [tree, "__range"]).withColumn(
        "number", F.col("__seq") - F.col("__first") + F.col("__before")).drop(
        "__seq", "__range", "__first", "__before")


class Witnesses:
    """Open subtrees of appended nodes, and each node's witness so far."""

    def __init__(self):
        self.open: list[tuple[int, str, int]] = []  # (level, digest, first node)
        self.sides: list[list[str]] = []
        self.siblings: list[list[str]] = []

    def append(self, digest: str) -> None:
        first = len(self.sides)
        self.sides.append([])
        self.siblings.append([])
        self._put(0, digest, first)

    def _put(self, level: int, digest: str, first: int) -> None:
        """An open subtree; one of the same level before it is its sibling and completes both."""
        while self.open and self.open[-1][0] == level:
            _, left, start = self.open.pop()
            self._extend(start, first, "R", digest)
            self._extend(first, len(self.sides), "L", left)
            digest, first, level = hashlib.sha256((left + digest).encode()).hexdigest(), start, level + 1
        self.open.append((level, digest, first))

    def _extend(self, first: int, end: int, side: str, sibling: str) -> None:
        for i in range(first, end):
            self.sides[i].append(side)
            self.siblings[i].append(sibling)

    def close(self, levels: int | None) -> str:
        """The root. Nodes without a sibling rise alone, to ``levels`` or as long as there are others."""
        while len(self.open) > 1 or (levels is not None and self.open[0][0] < levels):
            level, digest, first = self.open.pop()
            self._extend(first, len(self.sides), "N", "")
            self._put(level + 1, hashlib.sha256(digest.encode()).hexdigest(), first)
        return self.open[0][1]


def _appended(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` (tree, number, total, node, …) with block, sides, siblings and, once a block, its root."""
    schema = extended(nodes, "sides string, siblings string, root string")

    def append(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("number")
        found = Witnesses()
        for digest in rows.column("node").to_pylist():
            found.append(digest)
        root = found.close(levels if rows.column("total")[0].as_py() > 1 << levels else None)
        n = len(rows)
        return pa.Table.from_arrays(
            [*rows.columns, pa.array(["".join(s) for s in found.sides], pa.string()),
             pa.array(["".join(s) for s in found.siblings], pa.string()),
             pa.array([root] + [None] * (n - 1), pa.string())], [*rows.column_names, "sides", "siblings", "root"])

    return nodes.groupBy("tree", "block").applyInArrow(append, schema)


def witnessed(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (tree, number, node, …) with sides, siblings and top, and each tree's (tree, top).

    A task appends one block of 2**levels nodes at a time; block roots are the nodes of the
    next round. Rounds: the logarithm of the longest tree to the base 2**levels.
    """
    rounds, current = [], nodes
    while True:
        totals = cut(current.groupBy("tree").agg(F.count(F.lit(1)).alias("total")))
        # Dealt by block, not by tree as the join may leave them: a tree may hold most rows.
        dealt = current.join(few(totals, 100_000), "tree").withColumn(
            "block", F.shiftright("number", levels)).repartition("tree", "block")
        done = cut(_appended(dealt, levels), "zstd")
        rounds.append(done.drop("total"))
        current = done.where("root IS NOT NULL").select(
            "tree", F.col("block").alias("number"), F.col("root").alias("node"))
        if not (done.agg(F.max("block")).first()[0] or 0):
            break
    above = current.select("tree", F.lit(0).cast("bigint").alias("block"), F.lit("").alias("more_sides"),
                           F.lit("").alias("more"), F.col("node").alias("top"))
    for done in reversed(rounds):
        joined = done.drop("root").join(few(above, 100_000), ["tree", "block"]).withColumn(
            "sides", F.concat("sides", "more_sides")).withColumn(
            "siblings", F.concat("siblings", "more")).drop("more_sides", "more", "block")
        if done is rounds[0]:
            return joined, current.select("tree", F.col("node").alias("top"))
        above = cut(joined.select("tree", F.col("number").alias("block"), F.col("sides").alias("more_sides"),
                                  F.col("siblings").alias("more"), "top"))
    raise AssertionError("there is always a round")


def folded(leaf: Column, sides: Column, siblings: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    def step(done: Column, side: Column) -> Column:
        other, own = F.substring(done["rest"], 1, 64), done["node"]
        both = F.when(side == "L", F.concat(other, own)).when(side == "R", F.concat(own, other)).otherwise(own)
        return F.struct(F.sha2(both, 256).alias("node"), F.when(
            side == "N", done["rest"]).otherwise(F.substr(done["rest"], F.lit(65))).alias("rest"))

    each = F.when(sides == "", F.array().cast("array<string>")).otherwise(F.split(sides, ""))
    return F.aggregate(each, F.struct(leaf.alias("node"), siblings.alias("rest")), step)["node"]


def manifest(rows: DataFrame, by: str, order: Iterable[str], levels: int = LEVELS) -> DataFrame:
    """``rows`` with subroot, root, sides and siblings for its column leaf (hex digest).

    A tree for each value of the string ``by`` (null is one, and first), its leaves in
    ``order`` (nulls first) and, if tied, by leaf; the trees' roots, by UTF-8 bytes of
    ``by``, are the leaves of one more tree, whose root is ``root``. Equal rows are
    leaves of their own. ``rows`` should be narrow: text stays out of it. It may have no
    columns of the names made here; no rows give no rows.
    """
    keep = rows.columns
    # One row more tells equal leaves apart; which of them comes first changes nothing but that.
    named = rows.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col(by)), F.lit(""))).withColumn(
        "node", F.col("leaf")).withColumn("__tie", F.monotonically_increasing_id())
    own, tops = witnessed(numbered(cut(named), "tree", [*order, "leaf", "__tie"]), levels)
    roots = tops.select("tree", F.col("top").alias("node"), F.lit(0).alias("all"))
    above, _ = witnessed(cut(numbered(roots, "all", ["tree"]).select(
        F.lit("").alias("tree"), F.col("tree").alias("own"), "number", "node")), levels)
    above = cut(above.select(F.col("own").alias("tree"), F.col("sides").alias("more_sides"),
                             F.col("siblings").alias("more"), F.col("top").alias("root")))
    return own.join(few(above, 100_000), "tree").select(
        *keep, F.col("top").alias("subroot"), "root", F.concat("sides", "more_sides").alias("sides"),
        F.concat("siblings", "more").alias("siblings"))
