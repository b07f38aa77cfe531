"""Sharding by balanced label propagation.

Documents that share a link id are linked. Each starts in a shard by its hash. In every
round, joins give a link's documents the shard that most of them are in, among the shards
with room, and those elsewhere ask to move there. Quotas let through as many moves into a
shard as its capacity and the moves out of it allow. Documents without links cut nothing
wherever they are, so they are left out of the rounds and fill what room is left.

Shards may go a tenth over their quotas meanwhile. At the end sizes are made exact: a shard's rows beyond its quota, small links that found no
common shard and the unlinked rows are numbered, and the numbers are dealt to the shards' free places in order. Numbering is done
in many buckets with sums carried between them, so no shard is sorted in one task. What
reaches the driver is a number for each pair of shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut, with_row


def numbered(rows: DataFrame, by: str, name: str, spread: int = 256) -> DataFrame:
    """``rows`` (__row, link, …) with ``name``: 0, 1, … without gaps within each ``by``.

    Rows of one link get numbers in a row: small links come first, then ``big`` ones, then
    rows without a link (big is null), each by 16 bits of the link's hash, then by link and
    row. The rows of a big link are spread over ``spread`` buckets side by side, at most
    65,536: the caller makes them follow the number of rows.
    """
    tier = F.when(F.col("big").isNull(), 2).when(F.col("big"), 1).otherwise(0)
    h = F.xxhash64(F.coalesce("link", F.col("__row").cast("string")))
    fine = F.when(F.coalesce("big", F.lit(False)), F.pmod(F.xxhash64("__row"), F.lit(spread))).otherwise(
        F.pmod(F.shiftright(h, 8), F.lit(256)))
    bucket = (tier * 256 + F.pmod(h, F.lit(256))) * 65536 + fine
    rows = rows.withColumn("__bucket", bucket)
    before = Window.partitionBy(by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(by, "__bucket").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    own = Window.partitionBy(by, "__bucket").orderBy("link", "__row")
    return rows.join(offsets, [by, "__bucket"]).withColumn(
        name, F.row_number().over(own) - 1 + F.col("__before")).drop("__bucket", "__before")


def quotas(n: int, shards: int) -> np.ndarray:
    """Rows of each shard: as even as whole numbers can be."""
    return np.array([n // shards + (i < n % shards) for i in range(shards)], np.int64)


def _flows(asked: np.ndarray, load: np.ndarray, quota: np.ndarray) -> np.ndarray:
    """Per target shard, the share of the moves that fits; asked[i, j]: from i to j."""
    share = np.ones(len(quota))
    into = asked.sum(axis=0)
    for _ in range(50):
        out = (asked * share).sum(axis=1)
        room = np.maximum(quota - load + out, 0)
        share = np.minimum(1.0, np.where(into > 0, room / np.maximum(into, 1), 1.0))
    return share


def spread_of(n: int) -> int:
    """Buckets for the rows of a big link among ``n`` rows: a million rows each or fewer."""
    return min(65_536, max(256, -(-n // 1_000_000)))


def _by_size(rows: DataFrame, other: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``other`` (both with ``big``), those of big links without a shuffle.

    ``other`` has a row for each link, or link and shard. Only some 20 links a shard can
    be big (``assign``), so their part of it is small at any size of the input.
    """
    def part(df: DataFrame, big: bool) -> DataFrame:
        return df.where(F.col("big") == big)

    heavy = part(rows, True).join(F.broadcast(part(other, True).drop("big")), on, how)
    return heavy.unionByName(part(rows, False).join(part(other, False).drop("big"), on, how))


def _table(values, column: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(column) + 1)


def propagate(linked: DataFrame, quota: np.ndarray, rounds: int = 12, slack: float = 0.1) -> DataFrame:
    """``linked`` (__row, link, big) with shard, one row for each document.

    Shards may go over their quotas by the share ``slack`` on the way.
    """
    shards, most = len(quota), np.ceil(quota * (1 + slack))
    labels = cut(linked.withColumn("shard", F.pmod(F.xxhash64("__row"), F.lit(shards)).cast("int")))
    for turn in range(rounds):
        load = np.zeros(shards)
        for r in labels.groupBy("shard").count().collect():
            load[r["shard"]] = r["count"]
        counts = labels.groupBy("link", "big", "shard").agg(F.count(F.lit(1)).alias("n"))
        # The order of a link's shards: by its rows there, ties by a hash of both. A big
        # link goes where there is room; a small one may also change places with others.
        weight = F.struct("n", F.xxhash64("link", "shard"))
        room = _table([bool(x) for x in load < quota], "shard")
        open_to = F.when(room | ~F.col("big"), weight)
        best = counts.groupBy("link", "big").agg(
            F.max_by("shard", open_to).alias("to"), F.max(open_to).alias("to_weight"))
        here = counts.select("link", "big", "shard", weight.alias("weight"))
        wish = here.join(best, ["link", "big"]).where("to IS NOT NULL AND to_weight > weight").select(
            "link", "big", "shard", "to")
        asking = cut(_by_size(labels, wish, ["link", "shard"]).select("__row", "link", "big", "shard", "to"))
        asked = np.zeros((shards, shards))
        for r in asking.groupBy("shard", "to").count().collect():
            asked[r["shard"], r["to"]] = r["count"]
        if not asked.any():
            break
        share = _flows(asked, load, most)
        # Small links move whole or not at all; a big one in part.
        draw = F.when(F.col("big"), F.xxhash64("__row", F.lit(turn))).otherwise(F.xxhash64("link", F.lit(turn)))
        go = F.pmod(draw, F.lit(1 << 20)) < _table([float(x) for x in share], "to") * (1 << 20)
        moved = asking.where(go).select("__row", F.col("to").alias("new"))
        labels = cut(labels.join(moved, "__row", "left").select(
            "__row", "link", "big", F.coalesce("new", "shard").cast("int").alias("shard")))
    return labels


def assign(rows: DataFrame, shards: int = 24, rounds: int = 12) -> DataFrame:
    """``rows`` (__row, link, …) with shard and slot; shards' row counts differ by one at most.

    ``__row`` tells rows apart and ``link`` is a string or null (no link). slot counts
    from 0 in each shard without gaps. Repeated rows are rows of their own; fewer rows
    than shards leave the last shards empty; no rows give no rows. ``rows`` is read
    several times: give a table.
    """
    several = rows.where("link IS NOT NULL").groupBy("link").agg(
        F.count(F.lit(1)).alias("__n")).where("__n > 1")
    n = rows.count()
    quota, spread = quotas(n, shards), spread_of(n)
    # A big link is one that fills a good part of a shard: n rows make 20 to a shard at
    # most, or so, however many rows there are, so that a broadcast of them stays small.
    several = cut(several.select("link", (F.col("__n") * 20 > max(int(quota.min()), 1)).alias("big")))
    big = F.broadcast(several.where("big").select("link", "big"))
    marked = rows.select("__row", "link").join(big, "link", "left")
    few = several.where("NOT big").withColumnRenamed("big", "__few")
    # Rows of big links and without a link take no part in the join that shuffles.
    alone = F.col("big").isNotNull() | F.col("link").isNull()
    ids = cut(marked.where(alone).select("__row", "link", "big").unionByName(
        marked.where(~alone).drop("big").join(few, "link", "left").select(
            "__row", "link", F.col("__few").alias("big"))))
    labels = propagate(ids.where("big IS NOT NULL"), quota, rounds)
    # Small links that found no common shard are dealt again as a whole.
    split = cut(labels.where(~F.col("big")).groupBy("link").agg(
        F.min("shard").alias("a"), F.max("shard").alias("b")).where("a <> b").select("link"))
    small = labels.where(~F.col("big"))
    ranked = numbered(small.join(split, "link", "left_anti").unionByName(labels.where("big")),
                      "shard", "__at", spread)
    fits = F.col("__at") < _table([int(q) for q in quota], "shard")
    ranked = cut(ranked.withColumn("__fits", fits))
    kept = ranked.where("__fits").select("__row", "link", "big", "shard")
    free = quota.copy()
    for r in kept.groupBy("shard").count().collect():
        free[r["shard"]] -= r["count"]
    pool = ranked.where("NOT __fits").select("__row", "link", "big").union(
        small.join(split, "link", "left_semi").select("__row", "link", "big")).union(
        ids.where("big IS NULL").select("__row", "link", "big")).withColumn("__all", F.lit(0))
    pool = numbered(pool, "__all", "__at", spread)
    ends = [int(x) for x in np.cumsum(free)]
    # The first shard whose free places, counted on, reach beyond the number.
    place = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("__at")))
    dealt = pool.select("__row", "link", "big", place.cast("int").alias("shard"))
    slots = numbered(kept.union(dealt), "shard", "slot", spread).select("__row", "shard", "slot")
    return rows.join(slots, "__row")


def shard_documents(docs: DataFrame, shards: int = 24, rounds: int = 12) -> DataFrame:
    """(doc_id, size, text_crc32, link, shard, slot) of ``docs`` (doc_id, text).

    Documents of equal texts are linked. size: UTF-8 bytes of the text plus 8, with none
    for a null text, whose crc32 is that of no bytes; null texts are not linked, empty
    ones are. Null and repeated ids and repeated rows are documents of their own; other
    columns are ignored.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = cut(with_row(docs.select("doc_id", "text")).select(
        "__row", "doc_id", (F.octet_length("text") + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(F.encode("text", "UTF-8")).alias("link")))
    rows = rows.withColumn("size", F.coalesce("size", F.lit(8).cast("bigint")))
    return assign(rows, shards, rounds).select(
        "doc_id", "size", "text_crc32", "link", "shard", "slot")
