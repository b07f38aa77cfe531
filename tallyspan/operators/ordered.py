"""Operators that look back over the rows of a key in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspan.operators.segments import (
    COPIED,
    ROWS_PER_SEGMENT,
    SEGMENT,
    Cuts,
    find_cuts,
    same,
)


def with_lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    columns: dict[str, object],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add window columns that reach at most ``rows`` rows back within a key.

    ``columns`` maps a name to a function from the window (partitioned and ordered)
    to a column. ``order`` must be unique within a key. One shuffle; a hot key is
    cut into segments, each given a copy of the ``rows`` rows just before it.
    """
    cuts = find_cuts(df, keys, order, rows_per_segment)
    if cuts.empty:
        window = W.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: make(window) for name, make in columns.items()})
    window = W.partitionBy(*keys, SEGMENT).orderBy(*order)
    return (
        cuts.tag_with_overlap(df, rows)
        .withColumns({name: make(window) for name, make in columns.items()})
        .where(~F.col(COPIED))
        .drop(SEGMENT, COPIED)
    )


def previous(column: str, steps: int = 1):
    """The value ``steps`` rows before, for ``with_lookback``."""
    return lambda window: F.lag(column, steps).over(window)


def moving(aggregate: Column, rows: int):
    """An aggregate over the row and those before it, ``rows`` in all."""
    return lambda window: aggregate.over(window.rowsBetween(1 - rows, 0))


def count_within(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    span: str,
    name: str,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Add the number of rows of the same key from ``span`` before the row's time up
    to that time, both ends included. ``span`` is a day-time interval, such as '1 day'.
    Rows without a time count each other.

    Counted by differences: a row counts up at its time and down once it falls out of
    the span, and the count is the running sum. That is linear, where a window with a
    range frame adds its frame up anew for each row.
    """
    # Cuts are taken from the times at which a count changes, so that a span longer than
    # a segment does not leave the steps past the last row to one task.
    cuts = find_cuts(_steps(df, keys, time, span, F.lit(1)).select(*keys, time), keys, [time], rows_per_segment)
    if not cuts.tied:
        return _count_by_rows(df, cuts, keys, time, span, name)
    # Very many rows of a hot key share an instant. Count them per instant first, so
    # that one task gets each instant once, and join the counts to the rows.
    hot = cuts.hot(df)
    instants = hot.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("__rows"))
    counts = _count_by_rows(instants, cuts, keys, time, span, name, F.col("__rows"))
    by = [*keys, time]
    right = counts.select(*[F.col(c).alias(f"__r_{c}") for c in by], name)
    counted = hot.join(right, same(by, "__r_")).select(*df.columns, name)
    plain = Cuts(cuts.keys, cuts.order)
    return _count_by_rows(cuts.cold(df), plain, keys, time, span, name).unionByName(counted)


def _steps(df: DataFrame, keys: Sequence[str], time: str, span: str, rows: Column) -> DataFrame:
    """Step 0 counts up at the row's time and keeps its other columns; step 1 counts
    down a span later. The end is included, so step 1 comes after step 0."""
    later = F.col(time) + F.expr(f"INTERVAL {span}")
    changes = F.array(
        F.struct(F.col(time).alias("at"), F.lit(0).alias("step"), rows.alias("n")),
        F.struct(later.alias("at"), F.lit(1).alias("step"), (-rows).alias("n")),
    )
    kept = [c for c in df.columns if c not in keys and c != time]
    return df.withColumn("__c", F.explode(changes)).select(
        *keys, F.col("__c.at").alias(time), F.col("__c.step").alias("__step"),
        F.col("__c.n").alias("__change"),
        *[F.when(F.col("__c.step") == 0, F.col(c)).alias(c) for c in kept],
    )


def _count_by_rows(
    df: DataFrame,
    cuts: Cuts,
    keys: Sequence[str],
    time: str,
    span: str,
    name: str,
    rows: Column | None = None,
) -> DataFrame:
    """Count as ``count_within``, for rows that stand for ``rows`` rows each."""
    steps = _steps(df, keys, time, span, F.lit(1) if rows is None else rows)
    by = list(keys) if cuts.empty else [*keys, SEGMENT]
    steps = steps if cuts.empty else cuts.tag(steps)
    # A range frame takes in the rows of the same instant.
    so_far = W.partitionBy(*by).orderBy(time, "__step").rangeBetween(W.unboundedPreceding, 0)
    counted = steps.withColumn(name, F.sum("__change").over(so_far)).where(F.col("__step") == 0)
    if not cuts.empty:
        earlier = W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
        before = F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
        handed_on = (
            cuts.hot(steps).groupBy(*by).agg(F.sum("__change").alias("__n"))
            .select(*by, before)
        )
        counted = cuts.join(counted, handed_on, by, "left").withColumn(
            name, F.col(name) + F.coalesce("__before", F.lit(0))
        )
    return counted.select(*df.columns, name)
