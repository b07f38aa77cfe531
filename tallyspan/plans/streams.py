"""Queries that run as streams. Rows of the stream that are final are compared with a
batch query over the same windows.

Each takes the run's ``folder`` too. With the folder of an earlier run it goes on after
the last finished batch; without one it starts a run of its own in the shared folder,
which it leaves there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.plans.registry import query
from tallyspan.sources import run_folder, stream_table
from tallyspan.streaming import first_deliveries, join_within, run_available, session_counts, window_counts


@query("""
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n
    FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n
          FROM events GROUP BY 1, 2)
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
""")
def stream_hourly_events(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Provisional P31: streaming tumbling windows."""
    events = stream_table(spark, sf_dir, "events")
    counts = window_counts(events, "ts", "1 hour", "10 minutes", ["event_type"])
    return run_available(counts, folder or run_folder(spark, "hourly"))


@query("""
    WITH flagged AS (
        SELECT user_id, ts, event_id,
               CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (
        SELECT user_id, ts, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                              ROWS UNBOUNDED PRECEDING) AS k
        FROM flagged)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
           count(*) AS n
    FROM numbered GROUP BY user_id, k
    HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
""")
def stream_user_sessions(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Provisional P32: streaming sessions."""
    events = stream_table(spark, sf_dir, "events")
    counts = session_counts(events, "ts", "30 minutes", "10 minutes", ["user_id"])
    return run_available(counts, folder or run_folder(spark, "sessions"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_first_deliveries(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Provisional P33: streaming deduplication by event."""
    events = stream_table(spark, sf_dir, "events")
    return first_deliveries(events, ["event_id"], "ts", folder or run_folder(spark, "first-deliveries"))


@query("""
    SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n
    FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n
          FROM events GROUP BY 1, 2)
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
""")
def stream_late_events(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Provisional P34: windows that wait a day for late rows. The events come in order,
    so here none is late; the tests have events that come in time and too late."""
    events = stream_table(spark, sf_dir, "events")
    counts = window_counts(events, "ts", "1 hour", "1 day", ["event_type"])
    return run_available(counts, folder or run_folder(spark, "late"))


@query("""
    WITH c AS (SELECT * FROM events WHERE event_type = 'click'),
    p AS (SELECT * FROM events WHERE event_type = 'purchase')
    SELECT c.user_id, c.event_id AS click_id, c.ts AS click_ts, p.event_id AS purchase_id, p.ts AS purchase_ts
    FROM c LEFT JOIN p ON c.user_id = p.user_id AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
    WHERE p.event_id IS NOT NULL OR c.ts + INTERVAL 1 HOUR
        <= least((SELECT max(ts) FROM c), (SELECT max(ts) FROM p)) - INTERVAL 10 MINUTE
""")
def stream_clicks_to_purchases(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """Provisional P39: two streams joined, purchases up to an hour after a click, and clicks without one."""
    def kind(event_type: str, prefix: str) -> DataFrame:
        return stream_table(spark, sf_dir, "events").where(F.col("event_type") == event_type).select(
            "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"))

    pairs = join_within(kind("click", "click"), kind("purchase", "purchase"), ["user_id"],
                        "click_ts", "purchase_ts", "1 hour", "10 minutes", "left")
    return run_available(pairs, folder or run_folder(spark, "clicks"))
