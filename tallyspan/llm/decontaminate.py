"""Benchmark decontamination by winnowing.

Of every ``window`` consecutive words, the k-gram with the least hash is kept as a
fingerprint, in items and documents alike. A shared stretch of ``window`` words has the
same k-grams on both sides and so the same least one: every such stretch shares a
fingerprint at the same offset. Documents' fingerprints are joined with the items', and
each hit is extended to the whole windows over it, which are compared in full.

Documents far outnumber what hits, so a filter of fixed size, made of the items'
fingerprints, first drops in the map task what can't match. It only saves work: what it
lets through is joined, and what it drops has no equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut, extended, rows_written, with_row
from tallyspan.llm.words import BY_ALNUM_LOWER, Hasher, encode, least_in_window, spans

# The filter has this many 64-bit numbers (2 MB), whatever the benchmark's size.
FILTER_WORDS = 1 << 18
_HASH = Hasher(21)
_HITS = pa.list_(pa.struct([
    ("place", pa.int32()), ("length", pa.int32()), ("mark", pa.int64()),
    ("windows", pa.list_(pa.struct([("first", pa.int32()), ("key", pa.binary())])))]))
_HITS_SQL = ("array<struct<place: int, length: int, mark: bigint, "
             "windows: array<struct<first: int, key: binary>>>>")


def _winnow(hashes: np.ndarray, length: int, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) kept for stretches of ``length`` words.

    A stretch as long as the window keeps its least k-gram; shorter ones (items of
    fewer words) are their own only k-gram.
    """
    k = gram if length == window else length
    grams = _HASH.runs(hashes, k)
    places = np.unique(least_in_window(grams, length - k + 1))
    return places, grams[places] ^ np.uint64(length * 0x9E3779B97F4A7C15 & (2**64 - 1))


def _marks(text: str | None, lengths: list[int], window: int, gram: int, passes):
    """Number of words, and (place, length, fingerprint, windows) of each that ``passes``.

    windows: (first word, digest of the words) of each whole stretch that keeps it.
    """
    data = encode(text, BY_ALNUM_LOWER)
    starts, ends = spans(data)
    hits = []
    if len(starts):
        hashes, words = _HASH.words(data, starts, ends), None
        for length in lengths:
            if len(starts) < length:
                continue
            places, marks = _winnow(hashes, length, window, gram)
            good = passes(marks)
            for place, mark in zip(places[good].tolist(), marks[good].view(np.int64).tolist(), strict=True):
                words = words or data.split()
                k = gram if length == window else length
                firsts = range(max(0, place + k - length), min(place, len(words) - length) + 1)
                hits.append({"place": place, "length": length, "mark": mark, "windows": [
                    {"first": i, "key": xxhash.xxh3_128_digest(b" ".join(words[i:i + length]))}
                    for i in firsts]})
    return len(starts), hits


def _pass_over(table: DataFrame, lengths: list[int], window: int, gram: int, bits=None) -> DataFrame:
    """``table`` with n_words and hits for its ``text``; ``bits``: the filter, broadcast."""
    others = [c for c in table.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passes(marks: np.ndarray) -> np.ndarray:
            if bits is None:
                return np.ones(len(marks), bool)
            at = marks >> np.uint64(6) & np.uint64(FILTER_WORDS - 1)
            return bits.value[at] >> (marks & np.uint64(63)) & np.uint64(1) > 0

        for batch in batches:
            found = [_marks(t.as_py(), lengths, window, gram, passes) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array([n for n, _ in found], pa.int64()),
                 pa.array([h for _, h in found], _HITS)], [*others, "n_words", "hits"])

    return table.mapInArrow(run, extended(table, f"n_words bigint, hits {_HITS_SQL}", without=("text",)))


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, length) of the items' windows: ``window`` words, or all if fewer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [min(window, len(spans(encode(t.as_py(), BY_ALNUM_LOWER))[0]))
                 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__row"), pa.array(n, pa.int32())], ["__row", "length"])

    return items.select("__row", "text").mapInArrow(run, "__row bigint, length int")


def _filter_of(marks: DataFrame) -> np.ndarray:
    """The filter's bits: at most FILTER_WORDS rows reach the driver."""
    at = F.shiftrightunsigned("mark", 6).bitwiseAND(F.lit(FILTER_WORDS - 1))
    bit = F.expr("shiftleft(1L, cast(mark & 63L AS int))")
    rows = marks.groupBy(at.alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(FILTER_WORDS, np.uint64)
    for row in rows:
        out[row["at"]] = row["bits"] & (2**64 - 1)
    return out


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5,
) -> DataFrame:
    """What ``docs`` (doc_id, text) share with ``items`` (item_id, text).

    A-Z are lower-cased; words are digits, letters a-z and anything beyond ASCII. An
    item's windows are its stretches of ``window`` words, or all its words if fewer. A
    document word inside an occurrence of a window is hit. Returns __row, doc_id, n_words,
    spans (array of first word and length of the matched windows) and items (array of
    the item ids with a window here, sorted as strings).

    A null or empty text has no words and hits nothing, on either side; an item
    without words has no window; repeated items count once by id, items with a null id
    hit words but are not listed; repeated documents are rows of their own; other
    columns are ignored; with no items, nothing is hit.
    """
    spark = docs.sparkSession
    # Rows are read once and written with their numbers; items are read again.
    docs = with_row(docs).select("__row", "doc_id", "text")
    items = rows_written(items.select("item_id", "text"))
    sizes = cut(_item_windows(items, window).where("length > 0"))
    lengths = [r["length"] for r in sizes.select("length").distinct().collect()]  # window at most
    marked = cut(_pass_over(items.select("__row", "text"), lengths, window, gram).join(sizes, "__row").select(
        "__row", "length", F.explode("hits").alias("hit")).where("hit.length = length").select(
        "__row", "length", "hit.mark", "hit.windows"))
    marks = marked.select("mark").distinct()
    keys = marked.select("__row", "length", F.explode("windows.key").alias("key")).join(
        items.select("__row", "item_id"), "__row").select("length", "key", "item_id").distinct()
    bits = spark.sparkContext.broadcast(_filter_of(marks))
    found = cut(_pass_over(docs, lengths, window, gram, bits))
    hits = found.select("__row", F.explode("hits").alias("hit")).select(
        "__row", "hit.length", "hit.mark", "hit.windows").join(marks, "mark")
    windows = hits.select("__row", "length", F.explode("windows").alias("w")).select(
        "__row", "length", "w.first", "w.key").distinct()
    # Windows with the same items are one class, so that a passage of many items that is in
    # many documents is a row for each document.
    classes = cut(keys.groupBy("length", "key").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    named = cut(classes.select("ids").distinct().withColumn("class", F.md5(F.to_json("ids"))))
    classed = classes.select("length", "key", F.md5(F.to_json("ids")).alias("class"))
    matched = cut(windows.join(classed, ["length", "key"]))
    spans_of = matched.groupBy("__row").agg(
        F.sort_array(F.collect_set(F.struct("first", "length"))).alias("spans"))
    sets_of = cut(matched.groupBy("__row").agg(F.sort_array(F.collect_set("class")).alias("classes")))
    together = sets_of.select("classes").distinct()
    items_in = together.select("classes", F.explode("classes").alias("class")).join(named, "class").groupBy(
        "classes").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    items_of = sets_of.join(items_in, "classes").select("__row", "items")
    none = F.array().cast("array<string>")
    return found.select("__row", "doc_id", "n_words").join(
        spans_of, "__row", "left").join(items_of, "__row", "left").select(
        "__row", "doc_id", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<first:int,length:int>>")).alias("spans"),
        F.coalesce("items", none).alias("items"))
