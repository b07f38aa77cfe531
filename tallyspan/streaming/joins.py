"""Joining two streams by key and time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import as_instant


def join_within(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    span: str,
    delay: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs of the same key whose right time is from the left time up to ``span`` later,
    both ends included. With ``how`` "left" a left row without a match comes alone, once none can
    come any more: when both streams have passed its time by ``span`` and ``delay``.

    Each side is kept as state for as long as a row of the other may still match it, and
    no longer; rows later than ``delay`` are dropped. Times are wall-clock columns. The key
    is joined by a bucket of time as long as ``span``, a left row in one and a right row
    in two, so that the state of a hot key is spread over its buckets and tasks. Rows
    without a time or a key match nothing, and are not among the unmatched ones; repeated
    rows are rows of their own. Column names other than ``on`` must differ between the sides.
    """
    whole = left.sparkSession.sql(f"SELECT INTERVAL {span} AS span").first()["span"]
    width = whole // timedelta(microseconds=1)
    if width <= 0:
        raise ValueError("a span must be longer than nothing")

    def timed(df: DataFrame, time: str, name: str) -> DataFrame:
        there = [F.col(c).isNotNull() for c in (time, *on)]
        for condition in there:
            df = df.where(condition)
        return df.withColumn(name, as_instant(time)).withWatermark(name, delay)

    left, right = timed(left, left_time, "__l_at"), timed(right, right_time, "__r_at")
    bucket = {c: F.floor(F.unix_micros(F.col(c)) / width) for c in ("__l_at", "__r_at")}
    left = left.withColumn("__l_bucket", bucket["__l_at"])
    right = right.withColumn("__r_bucket", F.explode(F.array(bucket["__r_at"], bucket["__r_at"] - 1)))
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    same = (F.col("__l_bucket") == F.col("__r_bucket")) & (F.col("__r_at") >= F.col("__l_at")) & (
        F.col("__r_at") <= F.col("__l_at") + F.expr(f"INTERVAL {width} microseconds"))
    for c in on:
        same = same & (F.col(c) == F.col(f"__r_{c}"))
    return left.join(right, same, how).drop(
        "__l_at", "__r_at", "__l_bucket", "__r_bucket", *[f"__r_{c}" for c in on])
