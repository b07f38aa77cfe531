"""Benchmark decontamination against brute force, and its edge cases."""

import hashlib
import random
import re

import numpy as np

from tallyspan.llm.decontaminate import _winnow, contamination
from tallyspan.llm.queries import QUERIES
from tallyspan.llm.words import Hasher, spans

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items, window=10):
    windows = {}
    for i, t in items:
        w = words_of(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for t in texts:
        w, found = words_of(t), set()
        hit = [False] * len(w)
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k:k + n])) in windows:
                    hit[k:k + n] = [True] * n
                    found |= windows[key]
        out.append((len(w), sum(hit), sorted(str(i) for i in found if i is not None)))
    return out


def covered(spans_):
    return len({k for s in spans_ for k in range(s["first"], s["first"] + s["length"])})


def check(frame, texts, items, window=10):
    found = contamination(frame(list(enumerate(texts)), DOCS), frame(items, ITEMS), window).collect()
    got = {r["doc_id"]: (r["n_words"], covered(r["spans"]), r["items"]) for r in found}
    assert got == dict(enumerate(brute(texts, items, window)))


def test_every_window_keeps_a_fingerprint():
    draw = np.random.default_rng(5)
    data = " ".join(f"w{i}" for i in draw.integers(0, 6, 300)).encode()
    hashes = Hasher(21).words(data, *spans(data))
    places, _ = _winnow(hashes, 10, 10, 5)
    for first in range(len(hashes) - 9):
        assert any(first <= p <= first + 5 for p in places.tolist())


def test_random_texts_against_brute_force(frame):
    draw = random.Random(6)
    vocabulary = ["the", "of", "Cat", "x1", "é", "na", "to", "b", "sat", "日本"]
    text = lambda n: " ".join(draw.choice(vocabulary) + draw.choice(["", ",", ". ", "-"]) for _ in range(n))
    items = [(i, text(draw.choice([1, 3, 5, 9, 10, 11, 30]))) for i in range(12)]
    items += [(50, items[3][1]), (50, items[4][1]), (60, None), (61, "... !"), (None, text(10)), (62, "")]
    texts = [text(draw.randrange(60)) for _ in range(30)]
    for _ in range(30):
        texts.append(text(draw.randrange(9)) + "; " + draw.choice(items)[1:][0].__str__().upper() + " " + text(draw.randrange(9)))
    check(frame, texts, items)
    check(frame, texts, [(i, t) for i, t in items if len(words_of(t)) >= 10])


def test_hot_passage_long_and_empty_texts(frame):
    passage = " ".join(f"p{i}" for i in range(14))
    texts = [f"a{i} {passage} b" for i in range(60)] + [None, "", "—", "p0 " * 3000, passage * 2]
    check(frame, texts, [(i, passage + f" tail{i}") for i in range(20)])


def test_no_items_no_documents_nulls_and_clashing_columns(frame):
    docs = frame([(None, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", "x")], DOCS + ", items string")
    found = contamination(docs, frame([], ITEMS)).collect()
    assert sorted(r["n_words"] for r in found) == [3, 3, 3] and not any(r["spans"] or r["items"] for r in found)
    found = contamination(docs, frame([(4, "A, b!", 1)], ITEMS + ", doc_id int")).collect()
    assert [(covered(r["spans"]), r["items"]) for r in found] == [(2, ["4"])] * 3
    assert contamination(frame([], DOCS), frame([(4, "A, b!")], ITEMS)).collect() == []


def test_query(sf_folder, spark):
    texts = ["One two three four five six seven eight nine ten eleven", "nothing here", None]
    items = [(10, "one TWO three four five six seven eight nine ten"), (9, "two three four five six seven eight nine ten eleven")]
    folder = sf_folder({
        "documents": ([(i, t, "en", "s", 1) for i, t in enumerate(texts)],
                      "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "benchmark": (items, ITEMS)})
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_decontamination"](spark, folder).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {0: (11, 11, 2, sha("10,9"), True), 1: (2, 0, 0, sha(""), False), 2: (0, 0, 0, sha(""), False)}
