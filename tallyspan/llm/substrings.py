"""Substring dedup: words in long passages that occur more than once.

Level-wise doubling. Windows of a quarter of the final length that repeat are the only
ones extended to half of it, and of those only the repeated ones to the whole length. A
text without candidates adds nothing to a level's shuffle.

A level makes one shuffle of its windows' hashes, with counts and the first place made in
the map tasks, so that a passage in a third of all texts is a row for each task. Windows
that occur once come out of it by name and are taken from their texts' lists; nothing is
joined on a hash. Texts are moved once, into buckets by row, where every level finds them again. Copies of
a whole text need no levels: all their windows repeat, and only the first one of them
stands for the rest when other texts are compared.

At the first level not every window need be looked at. Two equal windows of the final
length have their least short window (by hash) at the same offset, so a window can
repeat only if its least short window does. That is one short window in about fourteen,
and it loses nothing. Later levels take the sub-window that still covers it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import bucketed, cut, with_row
from tallyspan.llm.words import BY_SPACE, Hasher, encode, least_in_window, spans

_PAIR = (Hasher(11), Hasher(12))
_BLOCK = 2_000_000


def levels(window: int) -> list[int]:
    """Window lengths, each at most twice the one before: 35 gives 9, 18, 35."""
    return sorted({-(-window // 4), -(-window // 2), window})


def _places(anchors: np.ndarray, firsts: np.ndarray, length: int, window: int) -> np.ndarray:
    """For windows of the final length, the first word of their sub-windows of ``length``.

    A sub-window covers the window's anchor, its least window of the first level.
    """
    return np.minimum(anchors, firsts + window - length)


def _hashes(texts: list[bytes], window: int, length: int, kept: list[np.ndarray] | None, before: int):
    """Sub-windows of ``length`` that may repeat in a block of ``texts``: (at, place, h1, h2).

    at: where each text's ones begin, and the end of the last's. ``kept``: of each text
    the places that repeat at the length ``before``; None at the first level. The texts
    are worked on as one run of words; no window reaches over the end of its text.
    """
    data = b" ".join(texts)
    starts, ends = spans(data)
    bytes_at = np.cumsum([0] + [len(t) + 1 for t in texts])
    first_words = np.searchsorted(starts, bytes_at)
    own_first, counts = first_words[:-1], np.diff(first_words)
    firsts = np.arange(len(starts))
    firsts = firsts[firsts + window <= np.repeat(first_words[1:], counts)]
    if not len(firsts):
        return (np.zeros(len(texts) + 1, np.int64), *[np.empty(0, np.int64)] * 3)
    words = _PAIR[0].words(data, starts, ends)
    base = levels(window)[0]
    short = _PAIR[0].runs(words, base)
    anchors = least_in_window(short, window - base + 1)[firsts]
    if kept is not None:
        repeats = np.zeros(len(starts), bool)
        repeats[np.concatenate([k + f for k, f in zip(kept, own_first, strict=True)])] = True
        repeats = repeats[_places(anchors, firsts, before, window)]
        anchors, firsts = anchors[repeats], firsts[repeats]
    places = _places(anchors, firsts, length, window)
    places = places[np.diff(places, prepend=-1) > 0]  # they never go back
    one = short if length == base else _PAIR[0].runs(words, length)
    two = one
    if length == window:  # the last level decides, so it compares 128 bits
        two = _PAIR[1].runs(_PAIR[1].words(data, starts, ends), length)
    at = np.searchsorted(places, first_words)
    own = places - np.repeat(own_first, np.diff(at))
    return at, own, one[places].view(np.int64), two[places].view(np.int64)


def _blocks(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about _BLOCK bytes."""
    first, total, i = 0, 0, -1
    for i, size in enumerate(sizes):
        total += size
        if total >= _BLOCK:
            yield first, i + 1
            first, total = i + 1, 0
    if first <= i:
        yield first, i + 1


def _level(docs: DataFrame, window: int, length: int, before: int) -> DataFrame:
    """(__row, place, h1, h2), arrays: the sub-windows of ``length`` that may repeat.

    ``docs`` has __row, text and, but for the first level, the places ``kept``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encode(text.as_py(), BY_SPACE) for text in batch.column("text")]
            for first, end in _blocks(map(len, texts)):
                kept = [np.asarray(batch.column("kept")[i].values) for i in range(first, end)] if before else None
                at, *found = _hashes(texts[first:end], window, length, kept, before)
                some = pa.array(np.flatnonzero(np.diff(at)))
                offsets = pa.array(np.unique(at).astype(np.int32) if len(some) else np.zeros(1, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__row").slice(first, end - first).take(some),
                     *[pa.ListArray.from_arrays(offsets, pa.array(values, kind))
                       for values, kind in zip(found, kinds, strict=False)]],
                    ["__row", "place", *keys])

    keys = ["h1", "h2"] if length == window else ["h1"]
    kinds = [pa.int32(), *[pa.int64()] * len(keys)]
    return docs.mapInArrow(run, "__row bigint, place array<int>, " + ", ".join(
        f"{k} array<bigint>" for k in keys))


def _repeated(rows: DataFrame) -> DataFrame:
    """(__row, kept): of the places in ``rows``, those whose hashes occur more than once."""
    keys = [c for c in rows.columns if c.startswith("h")]
    windows = rows.select("__row", F.explode(F.arrays_zip("place", *keys)).alias("w"))
    counted = windows.groupBy(*[F.col(f"w.{k}").alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("__row", "w.place")).alias("first"))
    once = counted.where("n = 1").select("first.__row", "first.place").groupBy("__row").agg(
        F.collect_list("place").alias("once"))
    left = F.array_except("place", F.coalesce("once", F.array().cast("array<int>")))
    return rows.select("__row", "place").join(once, "__row", "left").select(
        "__row", left.alias("kept")).where(F.size("kept") > 0)


def _kept_words(docs: DataFrame, window: int) -> DataFrame:
    kind = pa.list_(pa.struct([("first", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans_of, texts = [], [], []
            for i, text in enumerate(batch.column("text")):
                words = encode(text.as_py(), BY_SPACE).split()
                kept, gone = batch.column("kept")[i], np.zeros(len(words) + 1, np.int64)
                if batch.column("copied")[i].is_valid and len(words) >= window:
                    gone[0], gone[-1] = 1, -1  # all of it occurs elsewhere
                elif kept.is_valid:
                    at = np.asarray(kept.values)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                gone = (np.cumsum(gone) > 0)[:-1]
                edge = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                counts.append(len(words))
                spans_of.append([
                    {"first": a, "length": b - a}
                    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                texts.append(b" ".join(
                    [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                    if len(edge) else words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(spans_of, kind), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "removed", "kept"])

    return docs.mapInArrow(
        run, "doc_id bigint, n_words bigint, "
             "removed array<struct<first: int, length: int>>, kept string")


def remove_repeated(docs: DataFrame, window: int = 35) -> DataFrame:
    """Each text of ``docs`` (doc_id, text) without the words of repeated passages.

    A window is ``window`` consecutive words of one text. A word goes if some window
    over it occurs at another place too, in the same text or another; all are judged on
    the input. Returns doc_id, n_words, removed (first word and length of each removed
    stretch) and kept (the other words joined by one space).

    A null or empty text has no words and stays empty; a text shorter than the window
    loses nothing; rows with equal or null ids count as documents of their own, so
    repeated rows remove each other; other columns are ignored; no rows give no rows.
    """
    texts = bucketed(with_row(docs.select("doc_id", "text")), "__row")
    groups = texts.where("text IS NOT NULL").select("__row", F.md5(F.encode("text", "UTF-8")).alias("same"))
    first = groups.groupBy("same").agg(F.min("__row").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = cut(groups.join(first.where("n > 1"), "same").select(
        "__row", (F.col("__row") != F.col("first")).alias("copied")))
    texts = texts.join(copies, "__row", "left")
    compared = texts.where("copied IS NULL OR NOT copied").select("__row", "text")
    kept, before = None, 0
    for length in levels(window):
        source = compared if kept is None else compared.join(kept, "__row")
        rows = cut(_level(source, window, length, before))
        kept, before = cut(_repeated(rows)), length
    texts = texts.join(kept, "__row", "left")
    return _kept_words(texts.select("doc_id", "text", "copied", "kept"), window)
