"""Cross-tokenizer alignment by external spill counting.

A text is cut into tokens by two tokenizers, A and B. Byte offsets where tokens of both
end cut it into groups, and every A token is linked with the B tokens whose bytes it
overlaps. How many documents of the whole corpus hold a pair of ids linked says how far
the two tokens stand for each other.

Records (pair, document) are never gathered by pair. A block of texts sorts its own
records side-major, by A id and then B id, radix-partitioned by the A id's low digit, and
spills each partition as a zstd run: a head with each pair's number of documents, and a
body with the documents. Only heads are counted: they are merged k ways, ``fan_in`` runs at a time,
until each partition has one run. A pair's records are one row of a head however many
documents hold it, so a hot pair costs a row for each block. In side-major order all pairs
of an A id come together, so the last merge tells their largest count while it streams.
Then the counts stream back: the runs of a partition meet its counted pairs in order, and
each block's sums go to its documents.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.blocks import blocks
from tallyspan.llm.runs import merged, read_run, whole_run, write_run
from tallyspan.llm.tables import cut

BLOCK_BYTES = 1_000_000
_PART_BYTES = 250_000
# Fixed value: the words of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Up to here both libraries class letters, digits and spaces alike, whatever their Unicode version.
_SETTLED, _LONG = "ɏ", 20_000


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """The two tokenizers, made of the contents of their files."""

    def __init__(self, a: str, b: bytes):
        import sentencepiece
        import tiktoken
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        known, letters = json.loads(a), _letters()
        vocabulary = known["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in known["added_tokens"]}
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if i not in special}
        self.bytes_a = [b""] * (1 + max(chain(vocabulary.values(), special)))
        for piece, i in chain(ranks.items(), ((p, i) for i, p in special.items())):
            self.bytes_a[i] = piece
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
            else p.replace("▁", " ").encode()
            for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        # Where ids are the order of merges, another library gives the same ids several times as fast.
        step = known.get("pre_tokenizer") or {}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in known["model"]["merges"]]
        ordered = [vocabulary[m] for m in merges]
        plain = (step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
                 and known["normalizer"] is None and ordered == sorted(ordered))
        self.fast = tiktoken.Encoding(
            "a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if plain else None
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # The texts of ids, with what may follow them in the text of groups.
        self.written = [b"%d%s" % (i, end) for n, ends in ((len(self.bytes_a), b",|"), (len(self.bytes_b), b",;"))
                        for end in (ends[:1], ends[1:]) for i in range(n)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of a space and each text by A, and of each text by B, which adds the space."""
        quick = [self.fast is not None and len(t) <= _LONG and max(t, default="") <= _SETTLED for t in texts]
        slow = iter(self.a.encode_batch_fast(
            [" " + t for t, q in zip(texts, quick, strict=True) if not q], add_special_tokens=False))
        own = [self.fast.encode_ordinary(" " + t) if q else next(slow).ids
               for t, q in zip(texts, quick, strict=True)]
        return own, self.b.encode(texts, num_threads=1)


_READY: dict[tuple, Pair] = {}  # a worker makes its tokenizers once


def _ready(files: tuple[str, bytes]) -> Pair:
    key = tuple(hashlib.sha256(f.encode() if isinstance(f, str) else f).digest() for f in files)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Pair(*files)
    return _READY[key]


@dataclass
class Aligned:
    """A block of texts: counts by text, their groups in writing, and links (A id, B id, text)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    links: tuple[np.ndarray, np.ndarray, np.ndarray]


def align_block(pair: Pair, texts: list[str | None]) -> Aligned:
    """Tokens, groups and links of a block of ``texts``, worked on as one run of bytes."""
    found_a, found_b, counts_a, counts_b = [], [], [], []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < _PART_BYTES):
            size += len(texts[end] or "")
            end += 1
        given = [t or "" for t in texts[at:end]]
        for text, a, b in zip(given, *pair.encode(given), strict=True):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            good = text and b"".join([pair.bytes_a[i] for i in a]) == whole == b"".join(
                [pair.bytes_b[i] for i in b])
            a, b = (a, b) if good else ([], [])
            found_a.append(np.array(a, np.int64))
            found_b.append(np.array(b, np.int64))
            counts_a.append(len(a))
            counts_b.append(len(b))
        at = end
    empty = np.empty(0, np.int64)
    a, b = np.concatenate([*found_a, empty]), np.concatenate([*found_b, empty])
    n_a, n_b = np.array(counts_a, np.int64), np.array(counts_b, np.int64)
    text_a = np.repeat(np.arange(len(texts)), n_a)
    ends_a, ends_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    starts_a, starts_b = ends_a - pair.length_a[a], ends_b - pair.length_b[b]
    # A token's group: how many common ends come before its own end.
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    n_groups = np.bincount(text_a[np.searchsorted(ends_a, common)], minlength=len(texts))
    first = np.searchsorted(ends_b, starts_a, "right")
    over = np.searchsorted(starts_b, ends_a, "left") - first
    offsets = np.cumsum(over) - over
    other = b[np.arange(int(over.sum())) - np.repeat(offsets, over) + np.repeat(first, over)]
    links = np.repeat(a, over), other, np.repeat(text_a, over)
    return Aligned(n_a, n_b, n_groups, np.bincount(links[2], minlength=len(texts)),
                   _written(pair, a, b, group_a, group_b, n_a + n_b), links)


def _written(pair: Pair, a, b, group_a, group_b, sizes) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each text: a group's A ids, then its B ids."""
    n, m = len(pair.bytes_a), len(pair.bytes_b)
    codes = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = (np.diff(g, append=-1) != 0 for g in (group_a, group_b))
    codes[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = a + n * last_a
    codes[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 2 * n + b + m * last_b
    written, out, at = pair.written, [], 0
    for size in sizes.tolist():
        out.append(b"".join([written[c] for c in codes[at:at + size].tolist()])[:-1].decode())
        at += size
    return out


def _records(links, order: np.ndarray, width: int, texts: int) -> tuple[np.ndarray, ...]:
    """Records (key, text, times) of a block's links, sorted; a key is a pair, side-major."""
    a, b, text = links
    packed, times = np.unique((order[a] * width + b) * texts + text, return_counts=True)
    return packed // max(texts, 1), packed % max(texts, 1), times


_CODED = pa.schema([
    ("block", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("part", pa.int32()),
    ("head", pa.binary()), ("body", pa.binary())])
_CODED_SQL = ("block bigint, at int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups string, part int, head binary, body binary")


def _filled(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(n, f.type)) for f in _CODED], schema=_CODED)


def _code(docs: DataFrame, files: tuple[str, bytes], parts: int) -> DataFrame:
    """A row for each document, with part null, and one for each run of a block."""
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _ready(shared.value)
        ids = np.arange(len(pair.bytes_a))
        order = np.empty(len(ids), np.int64)  # A ids by their low digit, the part, and then by id
        order[np.lexsort((ids, ids % parts))] = ids
        first_of = np.cumsum([0] + [int((ids % parts == p).sum()) for p in range(parts)])
        width, number = len(pair.bytes_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in blocks(batch, "text", BLOCK_BYTES):
                found = align_block(pair, rows.column("text").to_pylist())
                n, number = len(rows), number + 1
                yield _filled({
                    "block": pa.array([number] * n, pa.int64()), "at": pa.array(range(n), pa.int32()),
                    "doc_id": rows.column("doc_id"), "n_a": pa.array(found.n_a), "n_b": pa.array(found.n_b),
                    "n_groups": pa.array(found.n_groups), "n_links": pa.array(found.n_links),
                    "groups": pa.array(found.groups, pa.string())})
                keys, text, times = _records(found.links, order, width, n)
                cuts = np.searchsorted(keys, first_of * width)
                spilled = []
                for part, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if i < j:
                        own, held = np.unique(keys[i:j], return_counts=True)
                        spilled.append((part, write_run([(own, held)]), write_run([(text[i:j], times[i:j])])))
                if spilled:
                    columns = [list(c) for c in zip(*spilled, strict=True)]
                    yield _filled({
                        "block": pa.array([number] * len(spilled), pa.int64()),
                        "part": pa.array(columns[0], pa.int32()), "head": pa.array(columns[1], pa.binary()),
                        "body": pa.array(columns[2], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, _CODED_SQL)


def _with_maxima(source, width: int):
    """(keys, counts, best): whether no pair of the same A id is in more documents.

    ``source`` comes in side-major order; only the pairs of one A id are ever held back.
    """
    held: tuple | None = None
    for part in chain(source, [None]):
        if part is None:
            ready, held = held, None
        else:
            whole = part if held is None else tuple(np.concatenate(x) for x in zip(held, part, strict=True))
            n = int(np.searchsorted(whole[0], whole[0][-1] // width * width))
            ready, held = (whole[0][:n], whole[1][:n]), (whole[0][n:], whole[1][n:])
        if ready is not None and len(ready[0]):
            keys, counts = ready
            sides = keys // width
            first = np.flatnonzero(np.diff(sides, prepend=-1))
            most = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(keys)))
            yield keys, counts, (counts == most).astype(np.int64)


def count_pairs(runs: DataFrame, width: int, fan_in: int) -> DataFrame:
    """(part, counted): one run for each part, of (pair, documents, best).

    ``runs``: part, block, head. A merge holds a chunk of each of its runs.
    """
    heads = runs.select("part", F.col("block").alias("run"), "head")
    left = heads.groupBy("part").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "run": [rows["run"].min()],
                             "head": [write_run(merged(rows["head"].to_list()))]})

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "counted": [
            write_run(_with_maxima(merged(rows["head"].to_list()), width))]})

    while left > fan_in:
        groups = -(-left // fan_in)
        heads = cut(heads.groupBy("part", F.pmod(F.xxhash64("run"), F.lit(groups))).applyInPandas(
            merge, "part int, run bigint, head binary"))
        left = heads.groupBy("part").count().agg(F.max("count")).first()[0]
    return cut(heads.groupBy("part").applyInPandas(finish, "part int, counted binary"))


def _sent_back(runs: DataFrame, counted: DataFrame, blocks_: int, fan_in: int) -> DataFrame:
    """(block, at, count_sum, n_best): the runs' pairs meet their counts, in order of pairs."""
    groups = max(1, -(-blocks_ // fan_in))
    spread = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    def stream(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        heads = [whole_run(h, 2) for h in rows["head"]]
        totals = [(np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)) for k, _ in heads]
        done = [0] * len(heads)
        for run in known["counted"]:
            for keys, counts, best in read_run(run, 3):
                for i, (own, _) in enumerate(heads):
                    end = int(np.searchsorted(own, keys[-1], "right"))
                    place = np.searchsorted(keys, own[done[i]:end])
                    totals[i][0][done[i]:end], totals[i][1][done[i]:end] = counts[place], best[place]
                    done[i] = end
        sums, bests = [], []
        for body, (_, held), (count, best) in zip(rows["body"], heads, totals, strict=True):
            text, times = _body(body)
            n = int(text.max()) + 1
            for out, value in ((sums, count), (bests, best)):
                total = np.zeros(n, np.int64)
                np.add.at(total, text, np.repeat(value, held) * times)
                out.append(total)
        return pd.DataFrame({"block": rows["block"], "count_sum": sums, "n_best": bests})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        n = max(len(x) for x in rows["count_sum"])
        out = {"block": np.repeat(rows["block"].iloc[0], n), "at": np.arange(n)}
        for name in ("count_sum", "n_best"):
            out[name] = sum(np.pad(np.asarray(x, np.int64), (0, n - len(x))) for x in rows[name])
        return pd.DataFrame(out)

    dealt = runs.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    known = counted.select("part", "counted", spread.alias("deal"))
    parts = dealt.groupBy("part", "deal").cogroup(known.groupBy("part", "deal")).applyInPandas(
        stream, "block bigint, count_sum array<bigint>, n_best array<bigint>")
    return parts.groupBy("block").applyInPandas(add, "block bigint, at int, count_sum bigint, n_best bigint")


def _body(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    return whole_run(run, 2)


def align(
    docs: DataFrame, a_path: str, b_path: str, parts: int = 16, fan_in: int = 128,
) -> tuple[DataFrame, DataFrame]:
    """The alignment of every text of ``docs`` (doc_id, text), and what the corpus says of its links.

    Returns two tables with a row for each document, told apart by (block, at):

    - block, at, doc_id, n_a, n_b, n_groups, n_links and groups: the ids of each group as
      ``a1,a2|b1;a3|b2,b3``.
    - block, at, count_sum, n_best: over the document's links, the sum of the pair's number
      of documents, and how many links have the largest number among their A id's pairs
      (ties included). A document without links has no row.

    A space is put before the text for A; B puts its own. Special tokens are plain text.
    Null and empty texts, and those that either tokenizer changes, have no tokens and zeros;
    null and repeated ids and repeated rows are documents of their own; other columns are
    ignored; no rows give no rows. ``a_path`` and ``b_path`` are read by the driver alone.

    At most ``fan_in`` runs meet in a task, each of a block of about 1 MB of text, and there
    the pairs of one of ``parts`` parts: their number is bounded by the vocabularies.
    """
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as file_a, open(b_path, "rb") as file_b:
        files = file_a.read(), file_b.read()
    coded = cut(_code(docs, files, parts), "zstd")
    runs = coded.where("part IS NOT NULL").select("part", "block", "head", "body")
    width = Pair(*files).b.get_piece_size()
    counted = count_pairs(runs, width, fan_in)
    back = cut(_sent_back(runs, counted, runs.select("block").distinct().count(), fan_in))
    documents = coded.where("part IS NULL").select(
        "block", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return documents, back
