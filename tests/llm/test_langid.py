"""Language identification: codes, held-out accuracy and edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import langid

DOCS = "doc_id bigint, text string, lang string"


def test_codewords_lie_apart_and_every_bit_splits():
    for n in range(2, 40):
        code = langid.codewords(n).astype(int)
        assert (np.abs(code.sum(axis=0)) < n).all()
        apart = (code.shape[1] - code @ code.T) // 2
        least = apart[~np.eye(n, dtype=bool)].min()
        assert least >= max(1, code.shape[1] // 5), n


def test_decoding_takes_the_nearest_codeword_and_flags_doubt():
    code = langid.codewords(4)
    model = langid.Model(["a", "b", "c", "d"], code, np.eye(8, code.shape[1], dtype=np.float32), np.ones(code.shape[1]))
    for i, language in enumerate(model.languages):
        for wrong in range(code.shape[1]):  # one classifier may be wrong
            counts = np.zeros(8)
            margins = code[i].astype(float)
            margins[wrong] *= -1
            counts[:code.shape[1]] = margins * 40
            counts[7] = 100 - counts.sum()  # the total is 100
            assert langid.decode(model, counts)[0] == language


def text_of(draw, letters, n):
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 8))) for _ in range(n))


LETTERS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop", "dd": "mnopqrst", "ee": "абвгдежз", "ff": "あいうえおかき"}


@pytest.fixture(scope="module")
def model(frame):
    draw = random.Random(1)
    rows = [(i, text_of(draw, LETTERS[x], draw.randrange(1, 60)), x)
            for i, x in enumerate(draw.choice(sorted(LETTERS)) for _ in range(600))]
    rows += [(900, None, "aa"), (901, "abc", None), (902, "", "bb"), (903, "123 456", "cc")]
    return langid.fit(frame(rows, DOCS), buckets=1 << 12)


def test_held_out_accuracy(frame, model):
    draw = random.Random(2)
    rows = [(i, text_of(draw, LETTERS[x], draw.randrange(4, 60)), x)
            for i, x in enumerate(draw.choice(sorted(LETTERS)) for _ in range(300))]
    got = langid.predict(frame(rows, DOCS), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_a_text_of_two_languages_is_ambiguous_or_scores_less(frame, model):
    draw = random.Random(3)
    mixed = " ".join(text_of(draw, LETTERS[x], 30) for x in ("aa", "cc"))
    pure = text_of(draw, LETTERS["aa"], 60)
    got = {r["doc_id"]: r for r in langid.predict(frame([(0, mixed, ""), (1, pure, "")], DOCS), model).collect()}
    assert got[0]["score"] < got[1]["score"] and not got[1]["ambiguous"]


def test_undetermined_texts_long_texts_and_clashing_columns(frame, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 !? ½", "x"), (4, "é" * 3, "x"), (5, "abc " * 500_000, "x"), (5, "abc", "x")]
    docs = frame(rows, DOCS).withColumn("score", F.lit("old")).withColumn("lang_pred", F.lit(1))
    got = langid.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]
    got = sorted((r["doc_id"], r["lang_pred"], r["score"] > 0) for r in got.collect())
    assert got[:3] == [(i, "und", False) for i in (1, 2, 3)]
    assert got[3][1] in LETTERS and got[4] == (5, "aa", True) and got[5] == (5, "aa", True)
    assert langid.predict(frame([], DOCS), model).collect() == []


def test_models_of_no_language_and_of_one(frame):
    none = langid.fit(frame([], DOCS))
    one = langid.fit(frame([(1, "abc", "aa")], DOCS))
    docs = frame([(1, "abc", "x")], DOCS)
    assert langid.predict(docs, none).first()["lang_pred"] == "und"
    assert langid.predict(docs, one).first()["lang_pred"] == "aa"


def test_long_texts_count_the_same_in_pieces(monkeypatch):
    text = text_of(random.Random(4), "abc dé", 400)
    whole = langid._Grams(512).counts(text)
    monkeypatch.setattr(langid, "_CHUNK", 37)
    assert (langid._Grams(512).counts(text) == whole).all()


def test_held_out_folds(spark):
    import zlib
    ids = [*range(50), None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", langid.held_out(F.col("doc_id")).alias("h"))
    assert {r["doc_id"]: r["h"] for r in rows.collect()} == {
        i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_copies_count_once_and_every_language_is_learned(frame):
    draw = random.Random(6)
    own = {x: [text_of(draw, LETTERS[x], 20) for _ in range(3)] for x in ("aa", "cc", "ee")}
    rows = [(x, t) for x in own for t in own[x]]
    many = [r for r in rows for _ in range(400)] + [("ff", text_of(draw, LETTERS["ff"], 20)) for _ in range(300)]
    docs = frame([(i, t, x) for i, (x, t) in enumerate(many)], DOCS)
    few = langid.fit(docs, per_language=30, buckets=1 << 10)
    assert few.languages == ["aa", "cc", "ee", "ff"]
    one = langid.fit(frame([(i, t, x) for i, (x, t) in enumerate(rows)], DOCS), buckets=1 << 10)
    alone = langid.fit(docs.where("lang <> 'ff'"), per_language=30, buckets=1 << 10)
    assert np.array_equal(one.weights, alone.weights)
