"""Splitting the rows of a hot key into ordered segments.

A window over (key, time) puts all rows of one key in one task. Where a key holds
a large share of the rows, that task never ends. The functions here look for such
keys in a small sample and cut their rows, at values of the ordering columns, into
segments of bounded size; the operators then use (key, segment) where they would
have used the key, and bring what a row needs from before its segment along.

The cuts are a table, one row for each hot key with its sorted cuts, that is written
to the shared folder so that every use of it sees the same cuts. Keys and places in
the order never leave Spark. Any cuts give the same rows: they decide only which task
works on which rows.

Keys that are not hot have one segment, number 0. Where no key is hot, ``Cuts`` is
empty and the operators fall back to the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspan.sources.sinks import write_shared

SEGMENT = "__segment"
COPIED = "__copied"
_CUTS = "__cuts"
_HOT = "__hot"

# A key is split once it holds about this many rows. It changes the plan, not the rows.
ROWS_PER_SEGMENT = 1_000_000
# Sampled rows in a segment. A segment's true size is within about 1/sqrt of this.
SAMPLES_PER_SEGMENT = 64
# A table about the cuts is broadcast up to this many cuts in all; beyond that it is
# joined as any other table.
BROADCAST_CUTS = 200_000
_SEED = 17


@dataclass(frozen=True)
class Cuts:
    """Where the rows of hot keys are cut: a segment starts at its cut."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    # Keys and ``__cuts``, the sorted places; None where no key is hot.
    table: DataFrame | None = None
    # Cuts of the key that has most of them, and of all keys.
    most: int = 0
    total: int = 0
    # Whether rows that tie in the order make a segment larger than it should be.
    tied: bool = False

    @property
    def empty(self) -> bool:
        return self.table is None

    def join(self, df: DataFrame, other: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        """Join a table that has at most a row for each cut. Null keys match each other."""
        renamed = other.withColumnsRenamed({c: f"__r_{c}" for c in on})
        if self.total <= BROADCAST_CUTS:
            renamed = F.broadcast(renamed)
        return df.join(renamed, same(on, "__r_"), how).drop(*[f"__r_{c}" for c in on])

    def _place(self, df: DataFrame) -> DataFrame:
        """Add the segment number, and whether the key is hot."""
        here = F.struct(*self.order)
        cuts = F.col(_CUTS)
        # How many cuts are at or before the place, by halving steps; a cut beyond the
        # last is null and so never passed.
        steps = [1 << bit for bit in reversed(range(self.most.bit_length()))]
        passed = F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda n, step: F.when(F.get(cuts, n + step - 1) <= here, n + step).otherwise(n),
        )
        return self.join(df, self.table, self.keys, "left").withColumns({
            SEGMENT: F.when(cuts.isNull(), 0).otherwise(passed), _HOT: cuts.isNotNull(),
        }).drop(_CUTS)

    def tag(self, df: DataFrame) -> DataFrame:
        """``df`` with a segment number."""
        return self._place(df).drop(_HOT)

    def tag_with_overlap(self, df: DataFrame, overlap: int) -> DataFrame:
        """``df`` with a segment number, and with copies of the last rows before each
        segment in it, marked ``COPIED``: ``overlap`` of them, or all there are.

        A segment hands its last ``overlap`` rows to the next one, and to those after it
        while there are fewer rows than that between. Spark keeps those rows in the map
        tasks (up to spark.sql.optimizer.windowGroupLimitThreshold of them), so what is
        shuffled for them is small.
        """
        placed = self._place(df)
        by = [*self.keys, SEGMENT]
        hot = placed.where(_HOT).drop(_HOT)
        following = W.partitionBy(*self.keys).orderBy(SEGMENT)
        counts = hot.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).withColumn(
            "__end", F.sum("__n").over(following.rowsBetween(W.unboundedPreceding, 0)))
        # Of segments that begin less than ``overlap`` rows after this one's end, the last.
        points = counts.select(*by, F.explode(F.array(
            F.struct((F.col("__end") - F.col("__n")).alias("at"), F.lit(1).alias("begins")),
            F.struct((F.col("__end") + overlap).alias("at"), F.lit(0).alias("begins")),
        )).alias("__p")).select(*by, "__p.*")
        up_to = W.partitionBy(*self.keys).orderBy("at", "begins").rowsBetween(W.unboundedPreceding, 0)
        reach = points.withColumn(
            "__last", F.max(F.when(F.col("begins") == 1, F.col(SEGMENT))).over(up_to),
        ).where((F.col("begins") == 0) & (F.col("__last") > F.col(SEGMENT))).select(*by, "__last")
        backwards = W.partitionBy(*by).orderBy(*[F.desc(c) for c in self.order])
        tail = hot.withColumn("__back", F.row_number().over(backwards)).where(
            F.col("__back") <= overlap).drop("__back")
        copies = self.join(tail, reach, by, "inner").withColumn(
            SEGMENT, F.explode(F.sequence(F.col(SEGMENT) + 1, F.col("__last")))).drop("__last")
        return placed.drop(_HOT).withColumn(COPIED, F.lit(False)).unionByName(
            copies.withColumn(COPIED, F.lit(True)))

    def segments(self) -> DataFrame:
        """All segments of the hot keys, as keys and number."""
        return self.table.select(
            *self.keys, F.explode(F.sequence(F.lit(0), F.size(_CUTS))).alias(SEGMENT))

    def hot(self, df: DataFrame) -> DataFrame:
        """The rows of hot keys only."""
        return self.join(df, self.table.select(*self.keys), self.keys, "left_semi")

    def cold(self, df: DataFrame) -> DataFrame:
        """The rows of all other keys."""
        return self.join(df, self.table.select(*self.keys), self.keys, "left_anti")


def same(on: Sequence[str], prefix: str) -> Column:
    """Whether the columns ``on`` equal those of that name after ``prefix``, nulls included."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in on])


def find_cuts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_segment: int = ROWS_PER_SEGMENT,
    distinct: bool = False,
) -> Cuts:
    """Find hot keys of ``df`` and cut their rows by the ``order`` columns.

    With ``distinct`` a key is hot only if it has more than about ``rows_per_segment``
    different places in the order.

    Runs now, as one job over a sample of about SAMPLES_PER_SEGMENT rows in
    ``rows_per_segment`` of the key columns, and others if a key is hot. Each reads
    ``df`` anew, so give a table or a checkpointed frame. Rows that tie in ``order`` stay
    in one segment, so give a unique order where ties may be many. Where a key is hot,
    ``spark.checkpoint.dir`` must name a folder all executors share.
    """
    keys, order = tuple(keys), tuple(order)
    fraction = min(1.0, SAMPLES_PER_SEGMENT / rows_per_segment)
    narrow = df.select(*keys, *[c for c in order if c not in keys])
    hot = _sample(df.select(*keys), fraction).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= SAMPLES_PER_SEGMENT).select(*keys)
    if hot.isEmpty():
        return Cuts(keys, order)

    def only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        wanted = wanted.withColumnsRenamed({c: f"__r_{c}" for c in keys})
        return rows.join(wanted, same(keys, "__r_"), "left_semi")

    if distinct:
        places = F.approx_count_distinct(F.struct(*order)).alias("__n")
        hot = only(narrow, hot).groupBy(*keys).agg(places).where(
            F.col("__n") > rows_per_segment).select(*keys)
    place = F.struct(*order)
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    found = (
        only(_sample(narrow, fraction), hot)
        .select(*keys, number.alias("__n"), place.alias("__cut"))
        .where(F.col("__n") % SAMPLES_PER_SEGMENT == 0)
        .groupBy(*keys)
        # Equal cuts, from ties in the order, become one.
        .agg(F.sort_array(F.collect_set("__cut")).alias(_CUTS), F.count(F.lit(1)).alias("__all"))
    )
    table = write_shared(found, "cuts")
    facts = table.agg(
        F.max(F.size(_CUTS)).alias("most"), F.sum(F.size(_CUTS)).alias("total"),
        F.max(F.size(_CUTS) < F.col("__all")).alias("tied"),
    ).first()
    if facts["most"] is None:
        return Cuts(keys, order)
    return Cuts(keys, order, table.drop("__all"), facts["most"], facts["total"], facts["tied"])


def _sample(df: DataFrame, fraction: float) -> DataFrame:
    return df if fraction >= 1.0 else df.sample(fraction, seed=_SEED)


def in_order(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Shuffle and sort as a window over (by, order) would.

    Doing so ahead of the window keeps what is computed for it, such as structs, out of
    the shuffle and the sort; the window finds the rows in place and adds neither.
    """
    return df.repartition(*by).sortWithinPartitions(*by, *order)
