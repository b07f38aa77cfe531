"""As-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspan.operators.segments import (
    ROWS_PER_SEGMENT,
    SEGMENT,
    find_cuts,
    in_order,
)

_TIME, _SIDE, _TIE, _MATCH = "__time", "__side", "__tie", "__match"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_order: tuple[str, str],
    right_order: tuple[str, str],
    how: str = "left",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Each left row with the latest right row of the same key at or before its time.

    ``left_order`` and ``right_order`` name the time and a column that is unique
    within a key at one time, with the same types on both sides. Right columns other than ``on`` are added and must not
    share a name with a left column. ``how`` is 'left', or 'inner' to keep matched
    rows only.

    Both sides are put in one sequence per key and the last right row is carried
    forward, so no pair is formed that is not in the result. A hot key is cut into
    segments; what each carries on to the next is one row.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    kept = [c for c in left.columns if c not in on and c not in left_order]
    carried = [c for c in right.columns if c not in on]
    # A row without a time comes neither before nor after another, and a null key equals none.
    right = right.where(F.col(right_order[0]).isNotNull()).dropna(subset=list(on))
    rows = _side(left, on, left_order, 1, kept).unionByName(
        _side(right, on, right_order, 0, [c for c in carried if c not in right_order]),
        allowMissingColumns=True,
    )
    order = [_TIME, _SIDE, _TIE]
    named = {right_order[0]: _TIME, right_order[1]: _TIE}
    match = F.struct(*[F.col(named.get(c, c)).alias(c) for c in carried])
    cuts = find_cuts(rows, on, order, rows_per_segment)
    by = list(on) if cuts.empty else [*on, SEGMENT]
    rows = rows if cuts.empty else cuts.tag(rows)
    so_far = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    latest = F.last(F.when(F.col(_SIDE) == 0, match), ignorenulls=True).over(so_far)
    joined = in_order(rows, by, order).withColumn(_MATCH, latest).where(F.col(_SIDE) == 1)
    if not cuts.empty:
        earlier = W.partitionBy(*on).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
        newest = (
            cuts.hot(rows.where(F.col(_SIDE) == 0))
            .groupBy(*by)
            .agg(F.max_by(match, F.struct(*order)).alias("__newest"))
        )
        # One whole right row for each segment. It may be wide, so it is not broadcast by
        # a hint: the rows lie by key and segment already and a plain join meets them there.
        # A null key matches nothing, and so needs nothing handed on.
        handed_on = cuts.segments().join(newest, by, "left").select(
            *by, F.last("__newest", ignorenulls=True).over(earlier).alias("__before")
        )
        joined = joined.join(handed_on, by, "left").withColumn(
            _MATCH, F.coalesce(_MATCH, "__before")
        )
    if how == "inner":
        joined = joined.where(F.col(_MATCH).isNotNull())
    named = {left_order[0]: _TIME, left_order[1]: _TIE}
    return joined.select(
        *[F.col(named.get(c, c)).alias(c) for c in left.columns],
        *[F.col(_MATCH)[c].alias(c) for c in carried],
    )


def _side(
    df: DataFrame, on: Sequence[str], order: tuple[str, str], side: int, others: Sequence[str]
) -> DataFrame:
    time, tie = order
    return df.select(
        *on, F.col(time).alias(_TIME), F.lit(side).alias(_SIDE), F.col(tie).alias(_TIE), *others
    )
