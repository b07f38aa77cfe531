"""Union of overlapping intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspan.operators.segments import ROWS_PER_SEGMENT, SEGMENT, Cuts, find_cuts


def interval_union(
    df: DataFrame,
    keys: Sequence[str],
    span: tuple[str, str],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """The longest stretches that a key's intervals cover without a break.

    ``span`` names the columns of an interval's first and last place, both of which belong to
    it: intervals that share one place are one stretch. Gives the keys, covered_from,
    covered_to and n_rows, the number of intervals in the stretch. Intervals with a null
    end or that end before they start are in none; repeated rows are counted each; null
    keys are a key; no rows give no rows.

    Equal intervals are counted in the map tasks. In order of their starts, an interval
    begins a stretch if it starts after the largest end so far. A hot key is cut into
    segments: each hands the largest end and the number of stretches so far to the ones
    after it, two numbers a segment, and the parts of a stretch are joined at last.
    """
    first, last = span
    rows = df.where(F.col(first) <= F.col(last)).groupBy(
        *keys, F.col(first).alias("__from"), F.col(last).alias("__to")).agg(F.count(F.lit(1)).alias("__n"))
    order = ["__from", "__to"]
    cuts = find_cuts(rows, keys, order, rows_per_segment)
    by = list(keys) if cuts.empty else [*keys, SEGMENT]
    if cuts.empty:
        rows = rows.withColumn("__reached", F.lit(None).cast(rows.schema["__to"].dataType))
    else:
        rows = cuts.tag(rows)
        rows = _carried(cuts, rows, F.max("__to"), F.max, "__reached")
    window = W.partitionBy(*by).orderBy(*order)
    reached = F.greatest(F.max("__to").over(window.rowsBetween(W.unboundedPreceding, -1)), "__reached")
    rows = rows.withColumn("__begins", (reached.isNull() | (F.col("__from") > reached)).cast("bigint"))
    so_far = window.rowsBetween(W.unboundedPreceding, 0)
    parts = rows.withColumn("__stretch", F.sum("__begins").over(so_far)).groupBy(*by, "__stretch").agg(
        F.min("__from").alias("covered_from"), F.max("__to").alias("covered_to"), F.sum("__n").alias("n_rows"))
    if not cuts.empty:
        parts = _carried(cuts, parts, F.max("__stretch"), F.sum, "__earlier")
        parts = parts.withColumn("__stretch", F.col("__stretch") + F.coalesce("__earlier", F.lit(0))).groupBy(
            *keys, "__stretch").agg(F.min("covered_from").alias("covered_from"),
                                    F.max("covered_to").alias("covered_to"), F.sum("n_rows").alias("n_rows"))
    return parts.select(*keys, "covered_from", "covered_to", "n_rows")


def _carried(cuts: Cuts, df: DataFrame, each, over_all, name: str) -> DataFrame:
    """``df`` with what the hot keys' segments before a row's own come to; null where there are none."""
    by = [*cuts.keys, SEGMENT]
    before = W.partitionBy(*cuts.keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
    table = cuts.hot(df).groupBy(*by).agg(each.alias("__each")).select(
        *by, over_all("__each").over(before).alias(name))
    return cuts.join(df, table, by, "left")
