"""Chat formatting: reply trees to conversations.

Messages name the message they answer. Iterative self-joins, each doubling how far a
message looks back, give every message its root, the sum of scores from the root down
and its place on the way; a tree as deep as 8,000 turns takes 13 of them. Leaves are the
branches' ends: they are ranked by score, the chosen ones' paths are walked back by the
same doubling, and each path is formatted as one conversation.

The template is ``<|im_start|>role`` newline, text, ``<|im_end|>`` newline for each turn.
In roles and texts a backslash becomes two and ``<|`` becomes ``<\\|``, so no text can
hold a mark, and reading back gives the text again; in roles a newline becomes ``\\n``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut

# The template.
START, END = "<|im_start|>", "<|im_end|>"


_RANGE_BITS = 33  # Fixed value: Spark's row ids count on from a multiple of 2**33 in each task.


def linked(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as messages: each answers the turn before it.

    Turns with equal numbers follow each other by role and text; null texts are empty;
    null roles are empty; a null turn comes first. Ids tell rows apart and grow along a
    conversation, with gaps; the first turn's parent is an id that the conversation has not.

    Rows are sorted in ranges, so a conversation of any length is spread over tasks. Inside a
    range a row's parent is the row before; a table with a row for each range leads from its
    first row to the range before.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # The range bounds are kept by the driver: a text's start is enough for them, the sort sees it whole.
    ranged = rows.repartitionByRange("conv_id", "turn", F.left("role", F.lit(64)), F.left("text", F.lit(64)))
    dealt = cut(ranged.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "conv_id", "role", "text", F.monotonically_increasing_id().alias("id")), "zstd")
    ends = dealt.groupBy(F.shiftright("id", _RANGE_BITS).alias("range")).agg(F.max("id").alias("last"))
    before = cut(ends.select(
        F.shiftleft("range", _RANGE_BITS).alias("first"),
        F.lag("last").over(Window.orderBy("range")).alias("before")))  # a row for each task of the sort
    joined = dealt.join(F.broadcast(before), F.col("id") == F.col("first"), "left")
    return joined.select(
        "conv_id", "id", "role", "text",
        F.when(F.col("first").isNull(), F.col("id") - 1).otherwise(F.col("before")).alias("parent"),
        F.lit(0.0).alias("score"))


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, branch, depth, id): the messages of the ``branches`` best paths of a tree.

    ``messages`` has conv_id, id, parent (null: a root) and score. A path goes from a
    root to a leaf, and its score is the mean of its messages'; ties go to the longer
    path and then to the smaller leaf id. branch counts from 1, depth from 0. A
    conversation with several roots is one tree. A message whose parent is missing is a
    root. Repeated ids of one conversation are one message; messages in a ring have no
    root and are left out.
    """
    nodes = messages.select("conv_id", "id", "parent", "score").dropDuplicates(["conv_id", "id"])
    there = nodes.select(F.col("conv_id").alias("c"), F.col("id").alias("p"))
    nodes = cut(nodes.join(
        there, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("p")), "left").select(
        "conv_id", "id", F.col("p").alias("up"), F.col("p").alias("parent"),
        F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(0).cast("bigint").alias("steps"),
    ).withColumn("steps", F.when(F.col("up").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")))
    # jumps[i]: (conv_id, id, up): the message 2**i answers back, where there is one. A
    # message that has looked back to its root is finished and joins no more.
    finished, looking, jumps = nodes.where("up IS NULL"), nodes.where("up IS NOT NULL"), []
    left, before = looking.count(), -1
    while left and left != before:  # messages that never finish hang on a ring
        jumps.append(looking.select("conv_id", "id", "up"))
        far = finished.union(looking).select(
            F.col("conv_id").alias("c"), F.col("id").alias("p"), F.col("up").alias("up2"),
            F.col("total").alias("total2"), F.col("steps").alias("steps2"))
        further = cut(looking.join(
            far, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("p"))).select(
            "conv_id", "id", F.col("up2").alias("up"), "parent",
            (F.col("total") + F.col("total2")).alias("total"),
            (F.col("steps") + F.col("steps2")).alias("steps")))
        finished, looking = finished.union(further.where("up IS NULL")), further.where("up IS NOT NULL")
        before, left = left, looking.count()
    nodes = finished
    inner = nodes.where("parent IS NOT NULL").select(
        F.col("conv_id").alias("c"), F.col("parent").alias("p")).distinct()
    leaves = nodes.join(
        inner, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("p")), "left_anti")
    rank = Window.partitionBy("conv_id").orderBy(
        (F.col("total") / (F.col("steps") + 1)).desc(), F.col("steps").desc(), "id")
    paths = leaves.withColumn("branch", F.row_number().over(rank)).where(
        F.col("branch") <= branches).select(
        "conv_id", "branch", "id", F.col("steps").alias("depth"))
    for i, jump in enumerate(jumps):
        back = jump.select(F.col("conv_id").alias("c"), F.col("id").alias("p"), "up")
        paths = cut(paths.union(paths.join(
            back, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("p"))).select(
            "conv_id", "branch", F.col("up").alias("id"), (F.col("depth") - 2 ** i).alias("depth"))))
    return paths.select("conv_id", "branch", "depth", "id")


def escaped(column: F.Column) -> F.Column:
    return F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def formatted_turns(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, branch, depth, piece, first, length): the turns of the best paths of each tree.

    ``messages``: conv_id, id, parent, role, text, score. The pieces of a path in order of
    depth are its conversation. first and length: the span of ``piece``, in code points, that
    counts in training; null but for an assistant's turn. A turn is a row, so a
    conversation may have any length.
    """
    paths = best_paths(messages, branches)
    told = messages.dropDuplicates(["conv_id", "id"]).select(
        F.col("conv_id").alias("c"), F.col("id").alias("p"), F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.lit(START), F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n")),
                 F.lit("\n")).alias("head"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"))
    turns = paths.join(told, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("p")))
    learned = F.col("role") == "assistant"
    return turns.select(
        "conv_id", "branch", "depth", F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        F.when(learned, F.char_length("head")).alias("first"),
        F.when(learned, F.char_length("body")).alias("length"))


def format_chats(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, branch, formatted, loss): the best paths of each tree as text.

    ``messages``: as for ``formatted_turns``. loss: array of (first, length) in code points
    of ``formatted``. One conversation is one row and so meets in one task, as its text does;
    ``formatted_turns`` is for those too long for that.
    """
    order = Window.partitionBy("conv_id", "branch").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, -1)
    turns = formatted_turns(messages, branches).withColumn(
        "at", F.coalesce(F.sum(F.char_length("piece")).over(order), F.lit(0)))
    mark = F.when(F.col("first").isNotNull(), F.struct(
        (F.col("at") + F.col("first")).cast("int").alias("first"), "length"))
    rows = turns.groupBy("conv_id", "branch").agg(F.sort_array(F.collect_list(
        F.struct("depth", "piece", mark.alias("mark")))).alias("turns"))
    return rows.select(
        "conv_id", "branch", F.array_join("turns.piece", "").alias("formatted"),
        F.filter("turns.mark", lambda m: m.isNotNull()).alias("loss"))


def unescape(text: str) -> str:
    """The text before escaping; a pair of backslashes stands for one."""
    return "\\".join(p.replace("<\\|", "<|") for p in text.split("\\\\"))


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for part in formatted.split(END + "\n")[:-1]:
        head, _, body = part.removeprefix(START).partition("\n")
        role = "\\".join(p.replace("\\n", "\n").replace("<\\|", "<|") for p in head.split("\\\\"))
        turns.append((role, unescape(body)))
    return turns


class _Read:
    """What reading a conversation back gives, added up turn by turn."""

    def __init__(self, key: tuple):
        self.key, self.turns, self.learned, self.chars = key, 0, 0, 0
        self.told, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, spans: list[tuple[int, int]]) -> None:
        for role, said in read_back(piece):
            self.turns += 1
            self.told.update(f"{role}\n{said}\n".encode())
        for first, length in spans:
            text = unescape(piece[first:first + length])
            self.learned += len(text)
            self.loss.update(text.encode())
        self.chars += len(piece)

    def row(self) -> tuple:
        return (self.key[0], self.turns, self.told.hexdigest(), self.learned, self.loss.hexdigest(), self.chars)


_DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_DIGESTS_SQL = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                "loss_sha256 string, formatted_chars bigint")


def _told(found: list[_Read]) -> pa.RecordBatch:
    columns = zip(*(f.row() for f in found), strict=True) if found else [[]] * len(_DIGESTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _DIGESTS, strict=True)], schema=_DIGESTS)


def digests(chats: DataFrame) -> DataFrame:
    """Counts and digests of what reading ``chats`` (from ``format_chats``) back gives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for conv, text, loss in zip(*(batch.column(c) for c in ("conv_id", "formatted", "loss")), strict=True):
                found.append(_Read((conv.as_py(),)))
                found[-1].add(text.as_py(), [(m["first"], m["length"]) for m in loss.as_py()])
            yield _told(found)

    return chats.select("conv_id", "formatted", "loss").mapInArrow(run, _DIGESTS_SQL)


def turn_digests(turns: DataFrame) -> DataFrame:
    """The same of ``turns`` (from ``formatted_turns``), a row for each conversation and branch.

    A conversation's turns stream through a task in order, which holds one batch of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            done = []
            for conv, branch, piece, first, length in zip(*(
                    batch.column(c) for c in ("conv_id", "branch", "piece", "first", "length")), strict=True):
                key = conv.as_py(), branch.as_py()
                if current is None or current.key != key:
                    done += [current] if current else []
                    current = _Read(key)
                start = first.as_py()
                current.add(piece.as_py(), [] if start is None else [(start, length.as_py())])
            yield _told(done)
        if current:
            yield _told([current])

    dealt = turns.repartition("conv_id", "branch").sortWithinPartitions("conv_id", "branch", "depth")
    return dealt.select("conv_id", "branch", "piece", "first", "length").mapInArrow(run, _DIGESTS_SQL)
