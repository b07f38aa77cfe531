"""Queries over events in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import amount, cents, exact_sum
from tallyspan.operators import (
    asof_join,
    count_within,
    interval_union,
    islands,
    moving,
    overlap_join,
    previous,
    range_join,
    regular_grid,
    sessions,
    with_lookback,
)
from tallyspan.plans.registry import query
from tallyspan.sources import read_table


def _kind(spark: SparkSession, sf_dir: str, event_type: str, prefix: str) -> DataFrame:
    """Events of one type, with time and id under names of their own."""
    return (
        read_table(spark, sf_dir, "events")
        .where(F.col("event_type") == event_type)
        .select(
            "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts")
        )
    )


@query("""
    SELECT c.user_id, c.event_id AS click_id, c.ts AS click_ts,
           p.event_id AS purchase_id, p.ts AS purchase_ts
    FROM events c JOIN events p ON c.user_id = p.user_id
     AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR
    WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def purchases_after_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P7: range join within a key, a purchase up to an hour after a click."""
    return range_join(
        _kind(spark, sf_dir, "click", "click"), _kind(spark, sf_dir, "purchase", "purchase"),
        ["user_id"], "click_ts", "purchase_ts", "1 hour",
    )


@query("""
    SELECT p.user_id, p.event_id AS purchase_id, p.ts AS purchase_ts,
           c.event_id AS click_id, c.ts AS click_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON p.user_id = c.user_id AND p.ts >= c.ts
""")
def last_click_before_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P8: as-of join."""
    return asof_join(
        _kind(spark, sf_dir, "purchase", "purchase"), _kind(spark, sf_dir, "click", "click"),
        ["user_id"], ("purchase_ts", "purchase_id"), ("click_ts", "click_id"), how="inner",
    )


@query("""
    SELECT user_id, event_id, ts, value,
           CAST(CAST(value AS DECIMAL(12,2))
                - lag(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                AS DOUBLE) AS change
    FROM events
""")
def value_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P15: change from the previous row."""
    events = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    changed = with_lookback(
        events, ["user_id"], ["ts", "event_id"], 1, {"before": previous("value")}
    )
    change = (cents("value") - cents("before")) / 100.0
    return changed.withColumn("change", change).drop("before")


@query("""
    SELECT user_id, event_id, ts,
           round(CAST(sum(CAST(value AS DECIMAL(12,2))) OVER last5 AS DOUBLE)
                 / count(value) OVER last5, 6) AS mean_of_5
    FROM events
    WINDOW last5 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
""")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P16: moving average over the last 5 rows."""
    events = read_table(spark, sf_dir, "events").select(
        "user_id", "event_id", "ts", cents("value").alias("value")
    )
    summed = with_lookback(
        events, ["user_id"], ["ts", "event_id"], 4,
        {"total": moving(F.sum("value"), 5), "n": moving(F.count("value"), 5)},
    )
    mean = F.round(F.col("total") / 100.0 / F.col("n"), 6)
    return summed.select("user_id", "event_id", "ts", mean.alias("mean_of_5"))


@query("""
    SELECT user_id, event_id, ts,
           count(*) OVER (PARTITION BY user_id ORDER BY ts
                          RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n_last_day
    FROM events
""")
def events_in_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P17: count over the last day."""
    events = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return count_within(events, ["user_id"], "ts", "1 day", "n_last_day")


@query("""
    WITH flagged AS (
        SELECT user_id, ts, event_id,
               CASE WHEN ts - lag(ts) OVER w <= INTERVAL 8 HOUR THEN 0 ELSE 1 END AS starts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (
        SELECT user_id, ts,
               sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS UNBOUNDED PRECEDING) AS n
        FROM flagged)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_rows
    FROM numbered GROUP BY user_id, n
""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P18: sessions by an inactivity gap of 8 hours."""
    events = read_table(spark, sf_dir, "events")
    return sessions(events, ["user_id"], "ts", "event_id", "8 hours")


@query("""
    WITH numbered AS (
        SELECT user_id, ts, event_type,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
             - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n
        FROM events)
    SELECT user_id, event_type, min(ts) AS run_start, max(ts) AS run_end, count(*) AS n_rows
    FROM numbered GROUP BY user_id, event_type, n
""")
def event_type_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P19: runs of equal values."""
    events = read_table(spark, sf_dir, "events")
    return islands(events, ["user_id"], "ts", "event_id", "event_type")


@query("""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL
""")
def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P21: tumbling windows."""
    return (
        read_table(spark, sf_dir, "events")
        .groupBy(F.window("ts", "1 hour"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            amount(exact_sum(cents("value")), 100).alias("total"),
        )
        .select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
    )


@query("""
    SELECT pane - k * INTERVAL 15 MINUTE AS window_start, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
    FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS pane, value FROM events),
         (SELECT unnest([0, 1, 2, 3]) AS k)
    GROUP BY 1
""")
def sliding_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P22: sliding windows of an hour, every 15 minutes.

    Rows are summed once per 15 minutes, and each sum then goes to the four windows
    it lies in. Sliding windows over the rows would copy every row four times.
    """
    panes = (
        read_table(spark, sf_dir, "events")
        .groupBy(F.window("ts", "15 minutes")["start"].alias("pane"))
        .agg(F.count(F.lit(1)).alias("n"), exact_sum(cents("value")).alias("total"))
    )
    return (
        panes.groupBy(F.window("pane", "1 hour", "15 minutes"))
        .agg(F.sum("n").alias("n"), amount(F.sum("total"), 100).alias("total"))
        .select(F.col("window.start").alias("window_start"), "n", "total")
    )


@query("""
    WITH held AS (
        SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS cell, count(*) AS n,
               CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(value) AS mean
        FROM events WHERE ts IS NOT NULL GROUP BY ALL),
    grid AS (
        SELECT user_id, unnest(generate_series(min(cell), max(cell), INTERVAL 6 HOUR)) AS cell
        FROM held GROUP BY user_id),
    around AS (
        SELECT g.user_id, g.cell, a.cell AS a_at, a.mean AS a_mean, a.n AS a_n, b.cell AS b_at, b.mean AS b_mean
        FROM grid g
        ASOF JOIN held a ON g.user_id = a.user_id AND g.cell >= a.cell
        ASOF JOIN held b ON g.user_id = b.user_id AND g.cell <= b.cell)
    SELECT user_id, cell AS grid_time, CASE WHEN cell = a_at THEN a_n ELSE 0 END AS n_rows,
           CASE WHEN cell = a_at THEN a_mean
                ELSE a_mean + (b_mean - a_mean) * (epoch(cell - a_at) / epoch(b_at - a_at)) END AS mean
    FROM around
""")
def filled_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P36: each user's mean value every 6 hours, gaps filled by interpolation."""
    events = read_table(spark, sf_dir, "events").select("user_id", "ts", cents("value").alias("value"))
    mean = amount(exact_sum("value"), 100) / F.count("value")
    return regular_grid(events, ["user_id"], "ts", "6 hours", {"mean": mean})


def _open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with lines, open from their date to the last shipment."""
    shipped = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderdate").alias("opened"), "closed")


@query("""
    WITH open_orders AS (
        SELECT o_custkey, o_orderkey, any_value(o_orderdate) AS opened, max(l_shipdate) AS closed
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey)
    SELECT a.o_custkey AS custkey, a.o_orderkey AS orderkey, b.o_orderkey AS other_orderkey,
           greatest(a.opened, b.opened) AS both_from, least(a.closed, b.closed) AS both_to
    FROM open_orders a JOIN open_orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey
     AND a.opened <= b.closed AND b.opened <= a.closed
    WHERE a.opened <= a.closed AND b.opened <= b.closed
""")
def orders_open_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P37: overlap join, two orders of a customer open at the same time."""
    held = _open_orders(spark, sf_dir)
    other = held.select("custkey", *[F.col(c).alias(f"other_{c}") for c in ("orderkey", "opened", "closed")])
    pairs = overlap_join(held, other, ["custkey"], ("opened", "closed"), ("other_opened", "other_closed"), "1 day")
    return pairs.where("orderkey < other_orderkey").select(
        "custkey", "orderkey", "other_orderkey", F.greatest("opened", "other_opened").alias("both_from"),
        F.least("closed", "other_closed").alias("both_to"))


@query("""
    WITH open_orders AS (
        SELECT o_custkey, o_orderkey, any_value(o_orderdate) AS opened, max(l_shipdate) AS closed
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey),
    flagged AS (
        SELECT *, CASE WHEN opened <= max(closed) OVER (
                   PARTITION BY o_custkey ORDER BY opened, closed, o_orderkey
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS begins
        FROM open_orders WHERE opened <= closed),
    numbered AS (
        SELECT *, sum(begins) OVER (PARTITION BY o_custkey ORDER BY opened, closed, o_orderkey
                                    ROWS UNBOUNDED PRECEDING) AS stretch
        FROM flagged)
    SELECT o_custkey AS custkey, min(opened) AS covered_from, max(closed) AS covered_to, count(*) AS n_rows
    FROM numbered GROUP BY o_custkey, stretch
""")
def customer_open_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P38: union of intervals, when each customer has some order open."""
    return interval_union(_open_orders(spark, sf_dir), ["custkey"], ("opened", "closed"))
