"""SentencePiece encoding against the library and plain Viterbi; round trips; edge cases."""

import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece

from tallyspan.llm import pieces
from tallyspan.llm.queries import PIECES, QUERIES

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "   a   b   ", "Hello world.", "don't «stop» — believing …",
    "line\nline\n\n line\t tab\r\nend\n", "日本語のテキスト 😀👍🏽 é ñ ß", "aaaaaaaaaaaaaaaaaaaaaaaa", "x" * 3000,
    "=" * 70 + " " + "-" * 33, "def f(x):\n        return x  # 1234567890", "​﻿\x00\x01", "ＡＢＣ ½ ①",
    "\\(a^2+b^2)\\ {x} <s> </s> <unk> <0x41>",
]


def test_same_ids_as_the_library(vocabulary, library):
    draw = random.Random(1)
    texts = TEXTS + ["".join(draw.choice("abcdeé ▁\n.the in er日") for _ in range(draw.randrange(60))) for _ in range(600)]
    encoder = pieces.Encoder(vocabulary)
    for text, got in zip(texts, encoder.texts(texts), strict=True):
        assert got.tolist() == library.encode(text), repr(text)


def test_the_walk_equals_encoding_each_word_alone(vocabulary):
    draw = random.Random(2)
    words = {"▁" + "".join(draw.choice("thein") for _ in range(draw.randrange(1, 12))) for _ in range(300)}
    together = pieces.Encoder(vocabulary)
    together.learn(words)
    for word in words:
        alone = pieces.Encoder(vocabulary)
        alone.learn([word])
        assert alone.known[word] == together.known[word]
        assert [vocabulary.ids[p] for p in vocabulary.merged(word)] == np.frombuffer(together.known[word], np.int32).tolist()


def test_scores_of_a_unigram_model_give_the_best_sum(vocabulary):
    own = pieces.Vocabulary.__new__(pieces.Vocabulary)
    own.__dict__.update(vars(vocabulary))
    draw = random.Random(3)
    names = sorted({"".join(draw.choice("ab▁c") for _ in range(draw.randrange(1, 5))) for _ in range(60)} | set("ab▁c"))
    own.scores = {p: -draw.random() * 9 - 0.1 for p in names}
    own.ids = {p: i for i, p in enumerate(names)}
    own.merges, own.least = False, min(own.scores.values()) - 10
    own.codes = {p: np.int32(i).tobytes() for p, i in own.ids.items()}
    own.lengths = {}
    for p in names:
        own.lengths[p[-2:]] = sorted({*own.lengths.get(p[-2:], [1]), len(p)}, reverse=True)
    for tail in list(own.lengths):  # lengths by two characters also hold for one
        own.lengths[tail] = sorted({*own.lengths[tail], 1}, reverse=True)

    def best(word):
        scores, paths = [0.0], [[]]
        for end in range(1, len(word) + 1):
            found = max(((scores[s] + own.scores[word[s:end]], paths[s] + [word[s:end]])
                         for s in range(end) if word[s:end] in own.scores), key=lambda x: x[0])
            scores.append(found[0])
            paths.append(found[1])
        return scores[-1]

    words = {"".join(draw.choice("ab▁c") for _ in range(draw.randrange(1, 14))) for _ in range(200)}
    encoder = pieces.Encoder(own)
    encoder.learn(words)
    for word in words:
        got = [names[i] for i in np.frombuffer(encoder.known[word], np.int32)]
        assert "".join(got) == word
        assert sum(own.scores[p] for p in got) == pytest.approx(best(word))


def test_round_trip_nulls_clashing_columns_and_no_rows(frame, vocabulary):
    texts = [t for t in TEXTS if "▁" not in t] + [None, "same", "same", "long word " * 20_000]
    docs = frame([(i, t, "old", 1) for i, t in enumerate(texts)], DOCS + ", decoded string, ids int")
    got = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    for r in got.collect():
        assert r["decoded"] == (r["text"] or "")
    both = pieces.encode(docs, vocabulary, decoded="decoded")
    assert both.columns == got.columns and sorted(map(str, both.collect())) == sorted(map(str, got.collect()))
    assert pieces.encode(frame([], DOCS), vocabulary).collect() == []


def test_blocks_take_every_row_once(monkeypatch):
    monkeypatch.setattr(pieces, "_BLOCK", 5)
    for sizes in ([], [0], [3, 6, 0, 1, 1, 10], [1] * 20):
        got = [i for first, end in pieces._blocks(sizes) for i in range(first, end)]
        assert got == list(range(len(sizes)))


def test_forgetting_changes_nothing(monkeypatch, vocabulary, library):
    monkeypatch.setattr(pieces, "_REMEMBERED", 3)
    encoder = pieces.Encoder(vocabulary)
    for text in TEXTS * 2:
        assert encoder.texts([text])[0].tolist() == library.encode(text)


def test_words_that_come_again_are_not_learned_again(monkeypatch, vocabulary, library):
    monkeypatch.setattr(pieces, "_REMEMBERED", 40)
    encoder, learned = pieces.Encoder(vocabulary), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: (learned.extend(words), learn(words)))
    for i in range(100):
        text = f"the usual words {i}x {i}y {i}z"
        assert encoder.texts([text])[0].tolist() == library.encode(text)
        assert len(encoder.known) + len(encoder.older) <= 60
    assert all(learned.count("▁" + word) == 1 for word in ("the", "usual", "words"))


def test_a_state_tries_the_pieces_that_a_text_ends_in(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    for text in ["▁international", "▁日本語のテキスト", "aaaa\U0010ffff=\U0010ffff", "▁the▁the"]:
        state = encoder.states[""]
        for end, letter in enumerate(text, 1):
            state = state[2].get(letter) or encoder.step(state, letter)
            ends = [text[at:end] for at in range(end - 1) if text[at:end] in vocabulary.codes]
            assert [piece for _, piece in state[1]] == [*ends, letter]
            assert all(n == len(piece) for n, piece in state[1])


def test_decoding_odd_ids(frame, vocabulary, spark):
    rows = frame([(1, [None, -1, 10 ** 6, 0]), (2, None), (3, []), (4, [vocabulary.byte_ids[255]])], "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in pieces.decode(rows, vocabulary).collect()}
    assert got == {1: "⁇ ", 2: "", 3: "", 4: "�"}


def test_query_over_real_texts(spark, sf_dir, library):
    import duckdb
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    rows = QUERIES["op4_sentencepiece"](spark, sf_dir).select("doc_id", "n_pieces", "ids", "round_trip").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"]) and r["ids"] == library.encode(texts[r["doc_id"]])


def test_a_megabyte_without_a_space_takes_bounded_memory():
    draw = random.Random(8)
    words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)),
             "".join(chr(draw.randrange(0x4E00, 0x9000)) for _ in range(100_000))]
    encoder = pieces.Encoder(pieces.Vocabulary(PIECES))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for word in words:
        tracemalloc.start()
        found = encoder.texts([word])[0].tolist()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200e6 and found == library.encode(word)
    assert not any(len(w) > 100 for w in encoder.known)


def message(**fields):
    out = b""
    for name, value in fields.items():
        n = int(name[1:])
        if isinstance(value, bytes):
            assert len(value) < 128
            out += bytes([n << 3 | 2, len(value)]) + value
        else:
            key = n << 3
            out += (bytes([key]) if key < 128 else bytes([key & 127 | 128, key >> 7])) + bytes([value])
    return out


@pytest.mark.parametrize("trainer, normalizer, kind", [
    ({"f3": 2}, {"f3": 1, "f4": 0}, "bpe"), ({"f3": 1}, {"f4": 0}, "unigram"), ({}, {"f4": 0}, "unigram"),
    ({"f3": 3}, {"f4": 0}, None), ({"f3": 2}, {}, None), ({"f3": 2}, {"f4": 0, "f3": 0}, None),
    ({"f3": 2}, {"f4": 0, "f2": b"map"}, None), ({"f3": 2, "f24": 1}, {"f4": 0}, None),
    ({"f3": 2}, {"f4": 0, "f5": 0}, None)])
def test_the_settings_are_the_model_files_own(trainer, normalizer, kind):
    model = message(f2=message(**trainer), f3=message(**normalizer))
    if kind is None:
        with pytest.raises(ValueError):
            pieces.model_kind(model)
    else:
        assert pieces.model_kind(model) == kind
