"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Texts are cut into marked words, the distinct words of a block of rows are sorted, and
the sorted list is walked as a trie, depth first: a word goes on from the forward scores
of the prefix it shares with the word before it. Blocks are independent, so nothing is
shuffled, and a worker remembers the words it has met, up to a bound.

For a unigram model a prefix's forward score is its best sum of piece scores. For a BPE
model that sum has no meaning, since a piece's score is its rank among the merges. There,
a prefix's path is allowed (score 0) or not: two neighbours are allowed if merging their
characters by rank gives just these two, and by that rule every prefix has exactly one
allowed path. So both kinds give the pieces that the model's own merging or search gives.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallyspan.llm.tables import extended

MARK = "▁"
_REMEMBERED, _LONGEST_REMEMBERED = 200_000, 100
_BLOCK = 1_000_000


def _fields(message: bytes) -> dict[int, int | bytes]:
    """The fields of a protocol buffer message by number, the last of each: numbers and bytes."""
    found, at = {}, 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            out, shift, at = out | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return out

    while at < len(message):
        field, kind = divmod(number(), 8)
        if kind == 0:
            found[field] = number()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else number()
        found[field] = message[at:at + size]
        at += size
    return found


def model_kind(model: bytes) -> str:
    """``bpe`` or ``unigram``, by the model's own settings; others are refused.

    So are models that change texts otherwise than these operators do, which put one mark
    before the text, make spaces marks and leave the rest alone.
    """
    # Numbers of the fields and of the kinds in a model file.
    top = _fields(model)
    trainer, normalizer = _fields(top.get(2, b"")), _fields(top.get(3, b""))
    kind = {1: "unigram", 2: "bpe"}.get(trainer.get(3, 1))
    if kind is None:
        raise ValueError("the model is neither a unigram nor a BPE model")
    changes = {"a table of replaced characters": normalizer.get(2, b""), "no mark before the text":
               not normalizer.get(3, 1), "extra spaces removed": normalizer.get(4, 1),
               "spaces that are not marks": not normalizer.get(5, 1), "marks after words": trainer.get(24, 0)}
    if any(changes.values()):
        raise ValueError("the model has " + ", ".join(k for k, v in changes.items() if v))
    return kind


class Vocabulary:
    """Pieces of a model file, read by the sentencepiece library on the driver."""

    def __init__(self, path: str):
        import sentencepiece  # on the driver alone

        with open(path, "rb") as file:
            kind = model_kind(file.read())
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.unknown = model.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(" ⁇ ".encode() if i == self.unknown else b"")
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        # The scores of a BPE model are the ranks of its merges.
        self.merges = kind == "bpe"
        several = [p for p in self.ids if len(p) > 1]
        # A word may end where no piece goes on: before a mark, and around a line end.
        self.ends = not any(MARK in p.lstrip(MARK) for p in several)
        self.alone = "".join(c for c in "\n\t\r" if not any(c in p for p in several))
        self.words = re.compile(
            f"{MARK}*[^{MARK}{self.alone}]+|{MARK}+|[{self.alone or MARK}]" if self.ends else r"[\s\S]+")
        self.least = min(self.scores.values(), default=0.0) - 10.0
        # Pieces that a path may hold, and the lengths of those that end in given characters.
        self.codes = {p: array("i", [i]).tobytes() for p, i in self.ids.items()
                      if not self.merges or len(p) == 1 or self.merged(p) == [p]}
        lengths: dict[str, set[int]] = {}
        for p in self.codes:
            lengths.setdefault(p[-2:], {1}).add(len(p))
        self.lengths = {tail: sorted(n, reverse=True) for tail, n in lengths.items()}

    def merged(self, text: str) -> list[str]:
        """The pieces left when the best-ranked neighbours are merged again and again."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]


# The longest end of a text that a piece begins with, the pieces that the text ends in with
# their lengths, longest first and its last character at least, and the states after it.
State = tuple[str, tuple[tuple[int, str], ...], dict[str, "State"]]


class Encoder:
    """Encodes words with a vocabulary, remembering pairs, states and words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.allowed: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.starts = {p[:n] for p in vocabulary.codes for n in range(1, len(p) + 1)} if vocabulary.merges else set()
        self.forget_states()

    def may_follow(self, a: str, b: str) -> bool:
        """Whether merging the characters of a and b leaves just these two."""
        after = self.allowed.get(a)
        if after is None:
            after = self.allowed[a] = {}
        found = after.get(b)
        if found is None:
            found = after[b] = self.v.merged(a + b) == [a, b]
            self.pairs += 1
        return found

    def forget_states(self) -> None:
        """Begin anew with the state of an empty text alone."""
        self.states: dict[str, State] = {"": ("", (), {})}
        self.steps = 0

    def step(self, state: State, letter: str) -> State:
        """The state after one more character."""
        tail, codes = state[0] + letter, self.v.codes
        while tail and tail not in self.starts:
            tail = tail[1:]
        after = self.states.get(tail or letter)
        if after is None:
            ends = [tail[i:] for i in range(len(tail) - 1) if tail[i:] in codes]
            after = self.states[tail or letter] = (tail, tuple((len(p), p) for p in [*ends, letter]), {})
            self.steps += 1
        if tail:  # a letter that begins no piece has its state whatever is before it
            state[2][letter] = after
            self.steps += 1
        return after

    def extend_allowed(self, word: str, lasts: list[str], states: list[State]) -> None:
        """Go on to the end of ``word`` by the allowed path of each of its prefixes.

        ``lasts``: the last piece of each prefix so far, which leads back to the prefix before
        it. ``states``: the state of each, whose pieces are tried, the longest first.
        """
        allowed, state = self.allowed, states[-1]
        for end in range(len(lasts), len(word) + 1):
            letter = word[end - 1]
            state = state[2].get(letter) or self.step(state, letter)
            for n, piece in state[1]:
                start = end - n
                if start == 0:
                    break
                try:
                    if allowed[lasts[start]][piece]:
                        break
                except KeyError:
                    if self.may_follow(lasts[start], piece):
                        break
            lasts.append(piece)
            states.append(state)

    def extend_scored(self, word: str, forward: list[float], lasts: list[str]) -> None:
        """Go on to the end of ``word`` by the best sum of scores of each of its prefixes."""
        v = self.v
        for end in range(len(forward), len(word) + 1):
            most, last = float("-inf"), ""
            for n in v.lengths.get(word[max(0, end - 2):end], (1,)):
                if n > end:
                    continue
                piece = word[end - n:end]
                if n == 1 or piece in v.codes:
                    total = forward[end - n] + v.scores.get(piece, v.least)
                    if total > most:
                        most, last = total, piece
            forward.append(most)
            lasts.append(last)

    def path(self, lasts: list[str]) -> bytes:
        """The ids of the whole word, from its last piece back to its first."""
        codes, at, out = self.v.codes, len(lasts) - 1, []
        while at:
            piece = lasts[at]
            try:
                out.append(codes[piece])
            except KeyError:
                out.append(self.fallback(piece))
            at -= len(piece)
        out.reverse()
        return b"".join(out)

    def learn(self, words: Iterable[str]) -> None:
        """Encode ``words``, depth first through the trie that their sorted list is."""
        if self.pairs > _REMEMBERED:
            self.allowed, self.pairs = {}, 0
        if self.steps > _REMEMBERED:
            self.forget_states()
        merges, known = self.v.merges, self.known
        forward, lasts, states, before = [0.0], [""], [self.states[""]], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del lasts[shared + 1:]
            if merges:
                del states[shared + 1:]
                self.extend_allowed(word, lasts, states)
            else:
                del forward[shared + 1:]
                self.extend_scored(word, forward, lasts)
            known[word] = self.path(lasts)
            before = word

    def fallback(self, letter: str) -> bytes:
        """The ids of a character that is no piece: its bytes', or else the unknown one."""
        if not self.v.byte_ids:
            return array("i", [self.v.unknown]).tobytes()
        return array("i", [self.v.byte_ids[b] for b in letter.encode("utf-8", "surrogatepass")]).tobytes()

    def cut(self, text: str | None) -> list[str]:
        """The text's marked words in order."""
        if not text:
            return []
        v = self.v
        if "  " in text or text[0] == " " or MARK in text or not v.ends:
            return v.words.findall(MARK + text.replace(" ", MARK))
        text = MARK + text.replace(" ", " " + MARK)
        for c in v.alone:
            if c in text:
                text = text.replace(c, f" {c} ")
        return text.split(" ")  # empty words have no ids

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.cut(t) for t in texts]
        if len(self.known) > _REMEMBERED // 2:  # words that come again are kept
            self.older, self.known = self.known, {}
        new = set().union(*cut).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((word, self.older[word]) for word in again)
        new -= again
        self.learn(new)
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32) for words in cut]
        for word in new:
            if len(word) > _LONGEST_REMEMBERED:
                del self.known[word]
        return out


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about _BLOCK bytes of text."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= _BLOCK:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _text_of(ids: np.ndarray, table: list[bytes]) -> str:
    """Marks become spaces and the first is dropped; other bytes than UTF-8 become U+FFFD."""
    return b"".join([table[i] for i in ids.tolist()]).removeprefix(b" ").decode("utf-8", "replace")


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str | None = None,
) -> DataFrame:
    """``docs`` with the piece ids of its column ``text`` in ``ids`` (array<int>).

    A null or empty text has no ids. Spaces become marks, one more is put before the
    text, and nothing else is changed. ``decoded`` names a column for the text that the
    ids give back, made in the same pass. Columns of these names are replaced; repeated
    rows are rows of their own; no rows give no rows.
    """
    new = [ids] if decoded is None else [ids, decoded]
    docs = docs.drop(*[c for c in new if c != text])
    others = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A broadcast value stays in its worker, and with it the words met in earlier tasks.
        if "encoder" not in shared.value:
            own = Vocabulary.__new__(Vocabulary)
            own.__dict__.update(shared.value)
            shared.value["encoder"] = Encoder(own)
        encoder = shared.value["encoder"]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
            for first, end in _blocks(sizes):
                part = batch.slice(first, end - first)
                found = encoder.texts(part.column(text).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found), pa.int32()))
                back = [] if decoded is None else [
                    pa.array([_text_of(f, encoder.v.bytes_of) for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in others], lists, *back], [*others, *new])

    kinds = f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded is not None else "")
    return docs.mapInArrow(run, extended(docs, kinds))


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of its column ``ids`` in ``text``.

    Marks become spaces and the first is dropped; ids outside the vocabulary and null
    ids are left out; bytes that are no UTF-8 become U+FFFD; null ids are an empty text.
    """
    docs = docs.drop(text)
    others = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.bytes_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            found = []
            for row in batch.column(ids):
                own = np.asarray(row.values.drop_null(), np.int64) if row.is_valid else np.empty(0, np.int64)
                found.append(_text_of(own[(own >= 0) & (own < len(table))], table))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(found, pa.string())], [*others, text])

    return docs.mapInArrow(run, extended(docs, f"`{text}` string"))
