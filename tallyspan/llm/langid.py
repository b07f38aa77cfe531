"""Language identification with error-correcting output codes.

Each language gets a codeword. For each bit of the codewords a binary classifier of
character n-grams, with weights from counts, tells the languages with that bit set from
the others. A text's bits come out as margins, and decoding takes the language whose
codeword loses least against them; a bit's loss counts by how well its classifier
separates its two sides. A language close behind the first makes the answer ambiguous.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut, extended, few

UNDETERMINED = "und"
_CHUNK = 1 << 20
_LONGEST_GRAM = 3
# A margin is the mean weight of a text's n-grams, times this; few n-grams weigh less.
_SHARPNESS, _FEW = 3.0, 4.0


@dataclass(frozen=True)
class Model:
    """What ``fit`` learns and ``predict`` needs; small enough to travel with a job."""

    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # per bit, summing to the number of bits


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A code of n words, +1 and -1, whose words lie far apart.

    Up to five words every split of the languages in two is a bit. Beyond that, bits
    are drawn, 12 for each doubling of n, and the best of 40 drawings is kept.
    """
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        splits = range(1, 2 ** (n - 1))
        return np.array([[1 if s >> i & 1 else -1 for s in splits] for i in range(n)], np.int8)
    draw, best, apart = np.random.default_rng(seed), None, -1
    bits = 12 * int(np.ceil(np.log2(n)))
    for _ in range(40):
        code = draw.choice(np.array([-1, 1], np.int8), (n, bits))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # a bit must split the languages
        distance = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = distance[~np.eye(n, dtype=bool)].min()
        if least > apart:
            best, apart = code, least
    return best


class _Grams:
    """Counts of a text's character n-grams by bucket."""

    letters: np.ndarray | None = None  # made once in each worker

    def __init__(self, buckets: int):
        self.buckets = buckets

    def counts(self, text: str | None) -> np.ndarray | None:
        """None if the text has no letter. Runs of other characters are one word end."""
        if _Grams.letters is None:
            _Grams.letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        if not text:
            return None
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        word = _Grams.letters[codes]
        if not word.any():
            return None
        codes = np.where(word, codes, 0)
        codes = codes[word | np.concatenate([[True], word[:-1]])]
        codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
        out = np.zeros(self.buckets)
        for n in range(1, _LONGEST_GRAM + 1):
            for start in range(0, len(codes) - n + 1, _CHUNK):
                part = codes[start:start + _CHUNK + n - 1]
                h = np.full(len(part) - n + 1, n, np.uint64)
                for i in range(n):
                    h = (h + part[i:i + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                if n == 1:
                    h = h[part > 0]
                out += np.bincount((h % np.uint64(self.buckets)).astype(np.int64), minlength=self.buckets)
        return out


def _gram_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, n) of each task's texts; docs: (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = _Grams(buckets), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                found = grams.counts(text.as_py())
                if found is not None:
                    sums[lang] = sums[lang] + found if lang in sums else found
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                 pa.array(n[at], pa.float64())], ["lang", "bucket", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, bucket int, n double")


def fit(
    docs: DataFrame, per_language: int = 5000, buckets: int = 1 << 14, smooth: float = 0.5,
    most_languages: int = 1000,
) -> Model:
    """A model of the labelled ``docs`` (text, lang); rows without either teach nothing.

    About ``per_language`` different texts of each language are used, chosen by a hash of
    the text; of a language with fewer, all. Copies of a text are one. What reaches the
    driver is one number for each language and bucket; a ``lang`` column of over
    ``most_languages`` values is no set of languages, and an error. No labelled rows give a
    model that knows no language.
    """
    docs = docs.select("text", "lang", F.xxhash64("text").alias("digest")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    texts = cut(docs.select("lang", "digest").distinct())
    counts_of = cut(texts.groupBy("lang").count())
    if counts_of.count() > most_languages:
        raise ValueError(f"the labels have over {most_languages} languages")
    share = counts_of.select("lang", F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count")).alias("share"))
    chosen = cut(texts.join(F.broadcast(share), "lang").where(
        F.pmod("digest", F.lit(1 << 40)) < F.col("share") * (1 << 40)).select("lang", "digest"))
    # Copies are put together in the map tasks, so a hot text is a row for each of them.
    chosen = docs.join(few(chosen), ["lang", "digest"], "left_semi").groupBy("lang", "digest").agg(
        F.first("text").alias("text"))
    rows = _gram_counts(chosen, buckets).groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in rows})
    counts = np.full((len(languages), buckets), smooth)
    place = {x: i for i, x in enumerate(languages)}
    for r in rows:
        counts[place[r["lang"]], r["bucket"]] += r["n"]
    p = counts / counts.sum(axis=1, keepdims=True) if languages else counts
    code = codewords(len(languages))
    weights = np.zeros((buckets, code.shape[1]))
    trust = np.zeros(code.shape[1])
    for b in range(code.shape[1]):
        if len(languages) > 1:
            yes, no = (p[code[:, b] == side].mean(axis=0) for side in (1, -1))
            weights[:, b] = np.log(yes / no)
            trust[b] = ((yes - no) * weights[:, b]).sum()  # how far the two sides lie apart
    trust = trust / trust.mean() if trust.any() else np.ones_like(trust)
    return Model(languages, code, weights.astype(np.float32), trust)


def decode(model: Model, counts: np.ndarray | None) -> tuple[str, float, float]:
    """(language, score, lead) for a text's counts of n-grams.

    score: share of the best language among exp(-loss) of all; lead: its score less the
    second one's.
    """
    if counts is None or not model.languages:
        return UNDETERMINED, 0.0, 0.0
    margins = _SHARPNESS * (counts @ model.weights) / (counts.sum() + _FEW)
    losses = (np.logaddexp(0.0, -model.code * margins) * model.trust).sum(axis=1)
    shares = np.exp(losses.min() - losses)
    shares /= shares.sum()
    best = int(np.argmin(losses))
    second = np.delete(shares, best).max(initial=0.0)
    return model.languages[best], float(shares[best]), float(shares[best] - second)


def predict(
    docs: DataFrame, model: Model, text: str = "text", least_lead: float = 0.2,
    names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"),
) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous for its column ``text``.

    ``und`` with score 0 where the text is null or has no letter, or where the model
    knows no language. ambiguous: another language's score is less than ``least_lead``
    behind. The whole text counts, however long; nothing but the text does. Columns of
    ``docs`` with the new ``names`` are replaced; no rows give no rows.
    """
    state = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model.__dict__))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(**pickle.loads(state.value))
        grams = _Grams(len(known.weights))
        for batch in batches:
            found = [decode(known, grams.counts(t.as_py())) for t in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others],
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[0] != UNDETERMINED and f[2] < least_lead for f in found], pa.bool_())],
                [*others, *names])

    docs = docs.drop(*names)
    others = docs.columns
    return docs.mapInArrow(run, extended(docs, ", ".join(
        f"`{name}` {kind}" for name, kind in zip(names, ("string", "double", "boolean"), strict=True))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is left out of the learning: the crc32 of its id's digits decides."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
