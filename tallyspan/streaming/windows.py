"""Windowed aggregates over a stream with late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import as_instant, as_wall_clock


def window_counts(
    stream: DataFrame,
    time: str,
    size: str,
    delay: str,
    keys: Sequence[str] = (),
    slide: str | None = None,
) -> DataFrame:
    """Rows per window and key, as window_start, window_end, keys and n.

    A window is final once the latest time seen has passed its end by ``delay``; rows
    that come for it after that are dropped. ``time`` is a wall-clock column. Rows are
    counted in the map tasks first, so a hot key or window shuffles one row per task.
    """
    window = F.window("__at", size, slide) if slide else F.window("__at", size)
    counts = (
        stream.withColumn("__at", as_instant(time))
        .withWatermark("__at", delay)
        .groupBy(window, *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(
        as_wall_clock(F.col("window.start")).alias("window_start"),
        as_wall_clock(F.col("window.end")).alias("window_end"),
        *keys, "n",
    )


def session_counts(
    stream: DataFrame, time: str, gap: str, delay: str, keys: Sequence[str]
) -> DataFrame:
    """Rows per session and key, as keys, session_start, session_end and n.

    A session ends ``gap`` after its last row. Set
    spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition so that a
    hot key shuffles sessions and not rows.
    """
    counts = (
        stream.withColumn("__at", as_instant(time))
        .withWatermark("__at", delay)
        .groupBy(F.session_window("__at", gap).alias("session"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(
        *keys,
        as_wall_clock(F.col("session.start")).alias("session_start"),
        as_wall_clock(F.col("session.end")).alias("session_end"),
        "n",
    )
