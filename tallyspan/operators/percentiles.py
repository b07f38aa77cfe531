"""Exact percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspan.operators.segments import ROWS_PER_SEGMENT, SEGMENT, find_cuts


def exact_percentile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    p: float,
    name: str,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """The percentile ``p`` of ``value`` per key, interpolated between neighbours. Nulls
    do not count.

    The built-in holds the distinct values of a group in one task. Where they are more
    than ``rows_per_segment``, the values are cut into segments instead: the segment
    sizes tell which one or two hold the percentile, and only their rows are put in
    order.
    """
    df = df.select(*keys, value).where(F.col(value).isNotNull())
    cuts = find_cuts(df, keys, [value], rows_per_segment, distinct=True)
    built_in = F.percentile(value, p).alias(name)
    if cuts.empty:
        return df.groupBy(*keys).agg(built_in)
    cold = cuts.cold(df).groupBy(*keys).agg(built_in)

    hot = cuts.tag(cuts.hot(df))
    earlier = W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
    at = (F.sum("__n").over(W.partitionBy(*keys)) - 1) * F.lit(float(p))
    sizes = (
        hot.groupBy(*keys, SEGMENT)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *keys, SEGMENT, "__n", at.alias("__at"),
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        )
        .withColumns({"__low": F.floor("__at"), "__high": F.ceil("__at")})
    )
    # Ranks count from 0. Keep the segments that hold the rank below or above.
    ends = F.col("__before") + F.col("__n")
    wanted = sizes.where(
        F.col("__low").between(F.col("__before"), ends - 1)
        | F.col("__high").between(F.col("__before"), ends - 1)
    ).drop("__n")
    # Equal values are counted before the shuffle, so one value may be hot too.
    values = (
        cuts.join(hot, wanted, [*keys, SEGMENT], "inner")
        .groupBy(*keys, SEGMENT, value, "__at", "__low", "__high", "__before")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    up_to = W.partitionBy(*keys, SEGMENT).orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    ranked = values.withColumn("__end", F.col("__before") + F.sum("__n").over(up_to))

    def holds(rank: str):
        return F.col(rank).between(F.col("__end") - F.col("__n"), F.col("__end") - 1)

    weight = F.col("__at") - F.col("__low")
    low = F.max(F.when(holds("__low"), F.col(value)))
    high = F.max(F.when(holds("__high"), F.col(value)))
    hot_result = (
        ranked.groupBy(*keys)
        .agg(low.alias("__l"), high.alias("__h"), F.max(weight).alias("__w"))
        .select(
            *keys,
            ((1 - F.col("__w")) * F.col("__l") + F.col("__w") * F.col("__h"))
            .cast("double").alias(name),
        )
    )
    return cold.unionByName(hot_result)
