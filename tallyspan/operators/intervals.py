"""Overlap join of intervals by an index of nested bucket sizes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import as_instant

GROWTH = 4  # each level's buckets are so many times as long as those of the level below


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    finest: str = "1 minute",
) -> DataFrame:
    """Pairs of the same key whose intervals share an instant; both ends belong to an interval.

    A span names the columns of an interval's first and last time. An interval lies on the
    level whose buckets are just as long as it is or longer, so it touches two of them at
    most, however long it is. Of a pair the one on the higher level waits in its own
    buckets; the other is copied to that level, two buckets at most again. So a row has
    two copies for each level that the other side's intervals are on, and never one for
    each bucket of a fine grid. A pair counts in the bucket where its common part begins,
    so none comes twice. Key, level and bucket are one equality: a hot key is spread over its
    buckets, and adaptive execution splits a bucket that is still hot.

    ``finest`` is the length of the lowest level's buckets; it changes the plan, not the
    rows. Intervals with a null end or that end before they start match nothing, nor does
    a null key; repeated rows are rows of their own. Column names other than ``on`` must differ
    between the sides. Both sides are read once more, to see which levels they have.
    """
    base = left.sparkSession.sql(f"SELECT INTERVAL {finest} AS w").first()["w"] // timedelta(microseconds=1)
    if base <= 0:
        raise ValueError("the finest buckets must be longer than nothing")
    left, right = _levelled(left, left_span, base, "l"), _levelled(right, right_span, base, "r")
    keys = [*on, "__level", "__bucket"]
    own_left = _copies(left, "l", base, [F.col("__l_level")])
    own_right = _copies(right, "r", base, [F.col("__r_level")])
    # A right row on the level of a left one, or below it, comes to that level; then the reverse.
    to_left = _copies(right, "r", base, [F.lit(n) for n in _levels(left, "l")], 0)
    to_right = _copies(left, "l", base, [F.lit(n) for n in _levels(right, "r")], 1)
    pairs = own_left.join(to_left, keys).unionByName(to_right.join(own_right, keys))
    first = F.greatest("__l_from", "__r_from")
    return pairs.where(
        (first <= F.least("__l_to", "__r_to")) & (F.col("__bucket") == _bucket(first, F.col("__level"), base))
    ).drop("__level", "__bucket", *[f"__{s}_{c}" for s in "lr" for c in ("from", "to", "level")])


def _levelled(df: DataFrame, span: tuple[str, str], base: int, side: str) -> DataFrame:
    """``df`` with its intervals in microseconds and their levels."""
    first, last = (F.unix_micros(as_instant(F.col(c))) for c in span)
    df = df.withColumns({f"__{side}_from": first, f"__{side}_to": last}).where(
        F.col(f"__{side}_from") <= F.col(f"__{side}_to"))
    length = F.col(f"__{side}_to") - F.col(f"__{side}_from") + 1
    level = F.greatest(F.lit(0), F.ceil(F.log(float(GROWTH), length / base)).cast("int"))
    return df.withColumn(f"__{side}_level", level)


def _levels(df: DataFrame, side: str) -> list[int]:
    """The levels in use: 32 at most, as times are 64 bits."""
    return sorted(r[0] for r in df.select(f"__{side}_level").distinct().collect())


def _bucket(at: Column, level: Column, base: int) -> Column:
    width = F.lit(base) * F.pow(F.lit(GROWTH), level).cast("bigint")
    return F.floor(at / width)


def _copies(df: DataFrame, side: str, base: int, levels: list[Column], above: int = 0) -> DataFrame:
    """A row for each bucket that an interval touches on those of ``levels`` that are
    ``above`` its own or more."""
    wanted = F.filter(F.array(*levels).cast("array<int>"), lambda n: n >= F.col(f"__{side}_level") + above)
    df = df.withColumn("__level", F.explode(wanted))
    first, last = (_bucket(F.col(f"__{side}_{c}"), F.col("__level"), base) for c in ("from", "to"))
    return df.withColumn("__bucket", F.explode(F.sequence(first, last)))
