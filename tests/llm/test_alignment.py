"""Alignment of two tokenizers against a plain count of the whole corpus."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from tallyspan.llm import alignment, queries, runs

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

TEXTS = [
    None, "", " ", "a", "The cat sat on the mat.", "The cat sat on the mat.", "the the the the", "naïve café",
    "日本語のテキスト and <|endoftext|> and </s> <s>", "a  b   c\n\n\td", "▁marks ▁▁", "\x00null\x00", "🙂👍🏽 emoji",
    "x" * 3000, "word " * 800, "don't we'll I'd 12345 3.14", " nbsp　wide", "ÅΩ ﬁ ① ½", "\r\n\r\n", "it's</s>",
]


def plain(texts):
    """One row for each text by direct use of both libraries."""
    a = tokenizers.Tokenizer.from_file(queries.BYTE_PIECES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    letters = alignment._letters()
    rows, links = [], []
    for text in texts:
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        other = b.encode(text) if text else []
        own = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids]
        its = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else
               b.id_to_piece(i).replace("▁", " ").encode() for i in other]
        if not text or b"".join(own) != b" " + text.encode() or b"".join(own) != b"".join(its):
            ids, other, own, its = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in own]), np.cumsum([len(x) for x in its])
        both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, low = [], 0
        for end in both:
            groups.append(",".join(str(i) for i, e in zip(ids, ends_a) if low < e <= end) + "|" + ",".join(
                str(i) for i, e in zip(other, ends_b) if low < e <= end))
            low = end
        links.append([(i, j) for i, e, x in zip(ids, ends_a, own) for j, f, y in zip(other, ends_b, its)
                      if e - len(x) < f and f - len(y) < e])
        rows.append((len(ids), len(other), len(groups), ";".join(groups)))
    count = Counter(pair for own in links for pair in set(own))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [(n, m, g, len(own), sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
             hashlib.sha256(text.encode()).hexdigest() if text else "")
            for (n, m, g, text), own in zip(rows, links, strict=True)]


def got(df):
    return sorted(
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_query_equals_a_plain_count(spark, sf_folder):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)]
    found = got(queries.op11_alignment(spark, sf_folder({"documents": (rows, DOCS)})))
    expected = [(i, n, m, g, k, best, total, digest)
                for i, (n, m, g, k, best, total, digest) in enumerate(plain(TEXTS))]
    assert found == expected


def test_many_small_runs_are_merged_in_levels(spark, frame, monkeypatch):
    texts = [f"number {i} of the {'cat' if i % 3 else 'dog'} sat" for i in range(60)]
    docs = frame([(i, t, 7) for i, t in enumerate(texts)], "doc_id bigint, text string, block int", files=9)
    rows, back = alignment.align(docs, queries.BYTE_PIECES, queries.PIECES, parts=3, fan_in=2)
    found = sorted((r.doc_id, r.n_links, r.n_best, r.count_sum) for r in rows.join(back, ["block", "at"]).collect())
    assert found == [(i, p[3], p[4], p[5]) for i, p in enumerate(plain(texts))]
    assert {r.doc_id: r.groups.count(";") + 1 for r in rows.collect()} == {
        r.doc_id: r.n_groups for r in rows.collect()}


def test_empty_table(spark, sf_folder):
    assert got(queries.op11_alignment(spark, sf_folder({"documents": ([], DOCS)}))) == []


def test_null_and_repeated_rows(spark, sf_folder):
    rows = [(None, "same text", None, None, None), (None, "same text", None, None, None), (3, None, None, None, None)]
    found = queries.op11_alignment(spark, sf_folder({"documents": (rows, DOCS)})).collect()
    same = [r for r in found if r.doc_id is None]
    assert len(found) == 3 and len(same) == 2 and same[0] == same[1]
    assert same[0].count_sum == 2 * same[0].n_links and same[0].n_best == same[0].n_links


def test_both_ways_of_encoding_agree(sf_dir, spark):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(200).collect()]
    with open(queries.BYTE_PIECES) as a, open(queries.PIECES, "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    quick = pair.encode(texts)
    pair.fast = None
    assert quick == pair.encode(texts)


@pytest.mark.parametrize("rows", [0, 1, runs.CHUNK, runs.CHUNK * 3 + 5])
def test_runs_give_back_what_was_written(rows):
    draw = np.random.default_rng(3)
    keys = np.sort(draw.choice(10**12, rows, replace=False))
    values = draw.integers(-5, 2**40, rows)
    back = runs.whole_run(runs.write_run([(keys, values)]), 2)
    assert all((x == y).all() for x, y in zip(back, (keys, values), strict=True))


def test_merge_adds_up_equal_keys():
    draw = np.random.default_rng(4)
    total, spilled = Counter(), []
    for n in (0, 1, 20_000, 30_000, 9):
        keys = np.unique(draw.integers(0, 40_000, n))
        spilled.append(runs.write_run([(keys, keys % 7 + 1)]))
        total.update(dict(zip(keys.tolist(), (keys % 7 + 1).tolist(), strict=True)))
    parts = list(runs.merged(spilled))
    keys = np.concatenate([k for k, _ in parts])
    assert (np.diff(keys) > 0).all()
    assert dict(zip(keys.tolist(), np.concatenate([c for _, c in parts]).tolist(), strict=True)) == total


def test_a_long_unbroken_word_and_a_long_text():
    with open(queries.BYTE_PIECES) as a, open(queries.PIECES, "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    texts = ["ab" * 200_000, "of the " * 100_000]
    found = alignment.align_block(pair, texts)
    assert (found.n_groups > 0).all() and found.n_links.sum() == len(found.links[0])
