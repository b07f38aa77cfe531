"""Runs of consecutive rows: sessions by inactivity, islands of equal values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspan.operators.segments import (
    COPIED,
    ROWS_PER_SEGMENT,
    SEGMENT,
    find_cuts,
    in_order,
)


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    gap: str,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Group the rows of a key into sessions: a new one starts after more than ``gap``
    without a row. A row without a time is in none. Gives keys, session_start, session_end and n_rows."""
    def starts(row_before: Column) -> Column:
        return F.col(time) - row_before[time] > F.expr(f"INTERVAL {gap}")

    rows = df.select(*keys, time, tie).where(F.col(time).isNotNull())
    found = _runs(rows, keys, [time, tie], [], starts, rows_per_segment)
    return found.select(
        *keys, F.col("__from").alias("session_start"), F.col("__to").alias("session_end"),
        F.col("__rows").alias("n_rows"),
    )


def islands(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    value: str,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Group the rows of a key into runs of one ``value``. Gives keys, value,
    run_start, run_end and n_rows."""
    def starts(row_before: Column) -> Column:
        return ~F.col(value).eqNullSafe(row_before[value])

    found = _runs(
        df.select(*keys, time, tie, value), keys, [time, tie], [value], starts, rows_per_segment
    )
    return found.select(
        *keys, value, F.col("__from").alias("run_start"), F.col("__to").alias("run_end"),
        F.col("__rows").alias("n_rows"),
    )


def _runs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    same: Sequence[str],
    starts,
    rows_per_segment: int,
) -> DataFrame:
    """First time, last time and count of each run. A run is known by the place of its
    first row; ``starts`` tells from the row before whether a row begins one. Columns
    in ``same`` are alike in all rows of a run."""
    time = order[0]
    place = F.struct(*order)
    summary = [
        F.min(time).alias("__from"), F.max(time).alias("__to"), F.count(F.lit(1)).alias("__rows")
    ]
    cuts = find_cuts(df, keys, order, rows_per_segment)
    by = list(keys) if cuts.empty else [*keys, SEGMENT]
    rows = in_order(df if cuts.empty else cuts.tag_with_overlap(df, 1), by, order)
    window = W.partitionBy(*by).orderBy(*order)
    so_far = window.rowsBetween(W.unboundedPreceding, 0)
    before = F.lag(F.struct(*order, *[c for c in same if c not in order])).over(window)
    rows = rows.withColumn("__before", before)
    first = F.col("__before").isNull() | starts(F.col("__before"))
    rows = rows.withColumn("__first", F.when(first, place))
    if not cuts.empty:
        # The copied rows only serve as the row before. Only a key's very first row has none.
        rows = rows.where(~F.col(COPIED))
    started = F.last("__first", ignorenulls=True)
    rows = rows.withColumn("__run", started.over(so_far))
    if cuts.empty:
        return rows.groupBy(*keys, "__run", *same).agg(*summary)

    # A part without a start goes on with the last run started in a segment before.
    # Those parts and the last run of each segment are put in order, a few per segment;
    # every other part is a whole run and keeps to itself, known by its start.
    whole_segment = window.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    parts = (
        rows.withColumn("__last", started.over(whole_segment))
        .groupBy(*by, "__run", "__last", *same)
        .agg(*summary)
    )
    alone = F.when(F.col("__run") != F.col("__last"), F.col("__run"))
    chain = (
        W.partitionBy(*keys, "__alone").orderBy(SEGMENT, "__run")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        parts.withColumn("__alone", alone)
        .withColumn("__run", F.last("__run", ignorenulls=True).over(chain))
        .groupBy(*keys, "__alone", "__run", *same)
        .agg(
            F.min("__from").alias("__from"), F.max("__to").alias("__to"),
            F.sum("__rows").alias("__rows"),
        )
    )
