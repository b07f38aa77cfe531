"""Ranking within groups and grouping at several levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group, numbered. ``order`` must be unique in a group.

    Spark keeps the first k rows of a group in each map task, so a hot group shuffles
    k rows per task. That holds up to k = spark.sql.optimizer.windowGroupLimitThreshold
    (1,000 by default).
    """
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint")
    return df.withColumn(rank, number).where(F.col(rank) <= k)


def rollup_totals(
    df: DataFrame, levels: Sequence[str], totals: dict[str, str], cube: bool = False
) -> DataFrame:
    """Subtotals over the prefixes of ``levels`` (all subsets with ``cube``).

    ``totals`` maps an output name to an input column to sum, or to '*' to count rows.
    Adds ``<level>_is_total`` (0 or 1) per level. Rows are summed at the finest level
    first: the subtotals then copy the sums once per level, not the rows.
    """
    finest = df.groupBy(*levels).agg(*[
        (F.count(F.lit(1)) if source == "*" else F.sum(source)).alias(name)
        for name, source in totals.items()
    ])
    grouped = finest.cube(*levels) if cube else finest.rollup(*levels)
    return grouped.agg(
        *[F.grouping(c).cast("int").alias(f"{c}_is_total") for c in levels],
        *[F.sum(name).alias(name) for name in totals],
    )
