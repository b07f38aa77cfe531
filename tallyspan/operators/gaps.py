"""A regular grid over time: rows summed by step, and the steps without rows filled in."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import as_instant
from tallyspan.operators.ordered import previous, with_lookback
from tallyspan.operators.segments import ROWS_PER_SEGMENT

# A gap is made in blocks of this many steps, so that no row holds a long gap as an array.
STEPS_PER_BLOCK = 4096


def regular_grid(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    step: str,
    values: dict[str, Column],
    name: str = "grid_time",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """One row for every step of each key, from its first step with rows to its last.

    Gives the keys, ``name`` (the step's start), ``n_rows`` and ``values``, which maps
    names to aggregates over a step's rows. A step without rows has n_rows 0, and its
    values, as doubles, lie on the straight line between the nearest steps with rows
    on either side; where one of the two is null, so are they. ``step`` is a day-time
    interval that divides time from 1970-01-01 00:00 on. ``keys`` names one column at least.

    Rows are aggregated by key and step in the map tasks first, so repeated rows and a hot
    step cost little. Each step with rows then looks back at the one before and makes the
    steps between, so that no grid is joined. A key that holds very many steps is cut into
    segments (``with_lookback``), each given the step before it. Null keys are a key; rows
    without a time take no part; no rows give no rows.
    """
    width = df.sparkSession.sql(f"SELECT INTERVAL {step} AS step").first()["step"] // timedelta(microseconds=1)
    if width <= 0:
        raise ValueError("a step must be longer than nothing")
    held = df.where(F.col(time).isNotNull()).groupBy(
        *keys, F.window(time, f"{width} microseconds").alias("__window")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[v.cast("double").alias(c) for c, v in values.items()])
    held = held.select(*keys, F.col("__window.start").alias(name), "n_rows", *values)
    before = {f"__{c}": previous(c) for c in (name, *values)}
    rows = with_lookback(held, keys, [name], 1, before, rows_per_segment)
    # The number of steps since the one before; a key's first step comes alone.
    micros = F.unix_micros(as_instant(F.col(name))) - F.unix_micros(as_instant(F.col(f"__{name}")))
    rows = rows.withColumn("__steps", F.coalesce((micros / width).cast("bigint"), F.lit(1).cast("bigint")))
    # Steps back from the row's own, block by block: 0 is the row itself.
    last = F.col("__steps") - 1
    rows = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(STEPS_PER_BLOCK).cast("bigint"))))
    rows = rows.withColumn("__back", F.explode(F.sequence(
        F.col("__block"), F.least(F.col("__block") + (STEPS_PER_BLOCK - 1), last))))
    share = (F.col("__steps") - F.col("__back")).cast("double") / F.col("__steps")

    def filled(column: str) -> Column:
        line = F.col(f"__{column}") + (F.col(column) - F.col(f"__{column}")) * share
        return F.when(F.col("__back") == 0, F.col(column)).otherwise(line).alias(column)

    return rows.select(
        *keys,
        (F.col(name) - F.expr(f"INTERVAL {width} microseconds") * F.col("__back")).alias(name),
        F.when(F.col("__back") == 0, F.col("n_rows")).otherwise(0).alias("n_rows"),
        *[filled(c) for c in values],
    )
