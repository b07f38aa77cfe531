"""Toxicity by a character n-gram linear classifier on naive Bayes log-count ratios.

Each n-gram's feature is how often it comes in a text, damped by a logarithm, times the
log ratio of the shares of toxic and other texts that have it. A logistic regression on
these features is fitted by L-BFGS: a Spark job sums loss and gradient over the sample
for each step, and the driver holds one number for each hashed n-gram.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.blocks import blocks
from tallyspan.llm.tables import cut, extended

GRAMS = (4, 5, 6)
BUCKETS = 1 << 17
_CHUNK = 1 << 20
_SCALE = 0.1  # keeps the features near one, so that one penalty suits all
_TASKS = 8  # the sample, which is bounded, is dealt to so many tasks


@dataclass(frozen=True)
class Model:
    """A weight for each bucket and a constant; ``weights`` is empty where nothing was learned."""

    weights: np.ndarray
    constant: float


class _Letters:
    known: np.ndarray | None = None  # made once in each worker


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a text's n-grams, in lower case.

    Runs of anything but letters and digits are one space, and one is put at either end.
    """
    if _Letters.known is None:
        _Letters.known = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    word = _Letters.known[codes]
    codes = np.where(word, codes, 32)[word | np.concatenate([[True], word[:-1]])[:len(word)]]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint64)
    dense = np.zeros(BUCKETS, np.int64) if len(codes) > _CHUNK else None
    found = []
    for n in GRAMS:
        for start in range(0, max(0, len(codes) - n + 1), _CHUNK):
            part = codes[start:start + _CHUNK + n - 1]
            h = np.full(len(part) - n + 1, n, np.uint64)
            for i in range(n):
                h = (h + part[i:i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            at = (h & np.uint64(BUCKETS - 1)).astype(np.int32)
            if dense is None:
                found.append(at)
            else:
                dense += np.bincount(at, minlength=BUCKETS)
    if dense is not None:
        at = np.flatnonzero(dense)
        return at.astype(np.int32), dense[at]
    return np.unique(np.concatenate([*found, np.empty(0, np.int32)]), return_counts=True)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is left out of the learning: the crc32 of its id's digits decides."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(text, toxic, weight): about ``per_label`` different texts of each label, or all if fewer.

    ``docs``: doc_id, text; ``labels``: doc_id, toxic. Texts are chosen by their hash. One of
    several labels is the commoner, ties toxic. A row's weight restores its label's share.
    """
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", (F.col("toxic") == 1).cast("double").alias("toxic"))
    texts = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"))
    told = cut(texts.join(labels, "doc_id").groupBy("digest").agg(
        (F.avg("toxic") >= 0.5).alias("toxic"), F.min("doc_id").alias("doc_id")))
    share = told.groupBy("toxic").agg(
        F.least(F.lit(1.0), F.lit(float(per_label)) / F.count(F.lit(1))).alias("share"))
    chosen = cut(told.join(F.broadcast(share), "toxic").where(
        F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) < F.col("share") * (1 << 40)).select(
        "doc_id", "digest", "toxic", (1 / F.col("share")).alias("weight")))
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("digest")).join(
        F.broadcast(chosen), ["doc_id", "digest"]).dropDuplicates(["digest"]).select("text", "toxic", "weight")


def _featured(rows: DataFrame) -> DataFrame:
    """(rows, lengths, buckets, counts), binary: n-grams of the sample's texts, some hundred KB a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in blocks(batch, "text", 200_000):
                found = [gram_counts(t.as_py()) for t in part.column("text")]
                sides = np.where(part.column("toxic").to_numpy(zero_copy_only=False), 1.0, -1.0)
                data = [sides * part.column("weight").to_numpy(),
                        np.array([len(f[0]) for f in found], np.int32),
                        np.concatenate([f[0] for f in found]).astype(np.int32),
                        np.log1p(np.concatenate([f[1] for f in found]) - 1.0).astype(np.float32) + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack(d.astype(k).tobytes())], pa.binary()) for d, k in zip(data, _KINDS, strict=True)],
                    ["rows", "lengths", "buckets", "counts"])

    return rows.mapInArrow(run, "rows binary, lengths binary, buckets binary, counts binary")


_KINDS = ("<f8", "<i4", "<i4", "<f4")


def _summed(packed: DataFrame, work, size: int) -> np.ndarray:
    """The sum over all packed rows of ``work(sides, weights, row, buckets, counts)``, ``size`` numbers.

    Each of a bounded number of tasks sends its own sum.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, unpack = np.zeros(size), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                signed, lengths, buckets, counts = (
                    np.frombuffer(unpack(row[c]), k)
                    for c, k in zip(("rows", "lengths", "buckets", "counts"), _KINDS, strict=True))
                total += work(signed > 0, np.abs(signed), np.repeat(np.arange(len(lengths)), lengths),
                              buckets, counts)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    out = np.zeros(size)
    for row in packed.coalesce(_TASKS).mapInArrow(run, "total binary").collect():
        out += np.frombuffer(row["total"])
    return out


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, kept: int = 8):
    """L-BFGS: the place that ``steps`` steps down from ``x`` lead to; ``loss`` gives value and gradient."""
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, factors = slope.copy(), []
        for move, change in reversed(moves):
            factors.append(move @ way / (change @ move))
            way -= factors[-1] * change
        way *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(
            np.abs(slope).sum(), 1e-12)
        for (move, change), factor in zip(moves, reversed(factors), strict=True):
            way += move * (factor - change @ way / (change @ move))
        length, expected = 1.0, slope @ way
        while True:
            there = x - length * way
            new, new_slope = loss(there)
            if new <= value - 1e-4 * length * expected or length < 1e-4:
                break
            length /= 2
        if new >= value:
            break
        if (there - x) @ (new_slope - slope) > 1e-12:
            moves = [*moves, (there - x, new_slope - slope)][-kept:]
        x, value, slope = there, new, new_slope
    return x


def fit(
    docs: DataFrame, labels: DataFrame, per_label: int = 3000, least_texts: int = 3, smooth: float = 1.0,
    penalty: float = 1e-5, steps: int = 14,
) -> Model:
    """A model of the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) names.

    Fitted on a sample of about ``per_label`` different texts of each label; copies of a
    text are one. N-grams in fewer than ``least_texts`` of them have no weight. Null labels
    and ids teach nothing; null texts are empty. Where no row is labelled, nothing is
    learned; where all have one label, the constant alone is.
    """
    packed = cut(_featured(sample(docs, labels, per_label).repartition(_TASKS)))

    def texts_with(toxic, weights, row, buckets, counts):
        own = [np.bincount(buckets[toxic[row] == side], minlength=BUCKETS) for side in (True, False)]
        return np.concatenate([*own, [toxic.sum(), (~toxic).sum(), weights[toxic].sum(), weights[~toxic].sum()]])

    found = _summed(packed, texts_with, 2 * BUCKETS + 4)
    (yes, no), (n_yes, n_no, all_yes, all_no) = found[:-4].reshape(2, BUCKETS), found[-4:]
    if n_yes + n_no == 0:
        return Model(np.empty(0, np.float32), 0.0)
    base = float(np.log((all_yes + 0.5) / (all_no + 0.5)))
    ratio = np.log((yes + smooth) / (n_yes + 2 * smooth) * (n_no + 2 * smooth) / (no + smooth))
    ratio = np.where(yes + no >= least_texts, ratio * _SCALE, 0.0) if n_yes and n_no else np.zeros(BUCKETS)
    whole = all_yes + all_no
    context = docs.sparkSession.sparkContext

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        shared = context.broadcast((x[:-1] * ratio, x[-1]))

        def work(toxic, weights, row, buckets, counts):
            weight, constant = shared.value
            z = np.bincount(row, weight[buckets] * counts, len(toxic)) + constant
            error = weights * (0.5 * (1 + np.tanh(0.5 * z)) - toxic)
            value = (weights * (np.logaddexp(0.0, z) - toxic * z)).sum()
            return np.concatenate([np.bincount(buckets, counts * error[row], BUCKETS), [error.sum(), value]])

        out = _summed(packed, work, BUCKETS + 2) / whole
        shared.destroy()
        slope = np.append(out[:-2] * ratio + penalty * x[:-1], out[-2])
        return float(out[-1] + penalty / 2 * (x[:-1] @ x[:-1])), slope

    start = np.append(np.zeros(BUCKETS), base)
    x = minimise(loss, start, steps) if n_yes and n_no else start
    return Model((x[:-1] * ratio).astype(np.float32), float(x[-1]))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the chance, 0 to 1, that its column ``text`` is toxic, in ``name``.

    The whole text counts, however long, and nothing but the text does. Null and empty
    texts have the constant's chance; a model that has learned nothing scores 0. A
    column called ``name`` is replaced; repeated rows are rows of their own; no rows give no rows.
    """
    docs = docs.drop(name)
    others = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.constant))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, constant = shared.value
        for batch in batches:
            found = []
            for t in batch.column(text):
                if len(weights):
                    buckets, counts = gram_counts(t.as_py())
                    z = (weights[buckets].astype(float) * (1 + np.log(counts))).sum() + constant
                    found.append(0.5 * (1 + np.tanh(0.5 * z)))
                else:
                    found.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(found, pa.float64())], [*others, name])

    return docs.mapInArrow(run, extended(docs, f"`{name}` double"))
