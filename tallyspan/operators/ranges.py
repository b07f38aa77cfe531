"""Range join within a key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    span: str,
    parts: int = 4,
) -> DataFrame:
    """Pairs of the same key whose right time is from the left time up to ``span`` later,
    both ends included. ``span`` is a day-time interval, such as '1 hour'.

    Time is cut into buckets, ``parts`` to a span. A left row lies in one; a right row is
    copied to its own and the ``parts`` before, which hold every left row it may match. The
    bucket joins the key as an equality, so that a hot key is spread over its buckets, and
    adaptive execution splits a bucket that is still hot. More parts make smaller buckets
    and more copies. Column names other than ``on`` must differ between the sides.
    """
    length = F.expr(f"INTERVAL {span}")
    whole = left.sparkSession.sql(f"SELECT INTERVAL {span} AS span").first()["span"]
    width = -(-(whole // timedelta(microseconds=1)) // parts)
    step = F.expr(f"INTERVAL {width} microseconds")
    buckets = f"{width} microseconds"
    left = left.withColumn("__bucket", F.window(left_time, buckets)["start"])
    own = F.window(right_time, buckets)["start"]
    right = right.withColumn("__own", own).withColumn(
        "__bucket", F.explode(F.array(*[F.col("__own") - step * i for i in range(parts + 1)]))
    ).drop("__own")
    pairs = left.join(right, [*on, "__bucket"])
    return pairs.where(
        (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + length)
    ).drop("__bucket")
