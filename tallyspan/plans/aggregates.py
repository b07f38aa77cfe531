"""Grouped aggregates, subtotals, percentiles and ranking within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import amount, cents, day_number, discounted, exact_sum
from tallyspan.operators import exact_percentile, rollup_totals, top_per_group
from tallyspan.plans.registry import query
from tallyspan.sources import read_table

# The kinds of event, which become columns of the pivot.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("""
    SELECT l_returnflag, l_linestatus,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_base_price,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))))
                AS DOUBLE) AS sum_disc_price,
           max(l_extendedprice) AS max_price,
           count(*) AS n_lines
    FROM lineitem
    WHERE l_shipdate <= TIMESTAMP '2001-09-02'
    GROUP BY l_returnflag, l_linestatus
""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P2: grouped sum, count and max, combined in the map tasks."""
    return (
        read_table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            amount(exact_sum(cents("l_quantity")), 100).alias("sum_qty"),
            amount(exact_sum(cents("l_extendedprice")), 100).alias("sum_base_price"),
            amount(exact_sum(discounted("l_extendedprice", "l_discount")), 10_000).alias(
                "sum_disc_price"
            ),
            F.max("l_extendedprice").alias("max_price"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


@query("""
    SELECT p_brand, p_type,
           CAST(grouping(p_brand) AS INTEGER) AS p_brand_is_total,
           CAST(grouping(p_type) AS INTEGER) AS p_type_is_total,
           count(*) AS n_parts,
           CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS total_price
    FROM part GROUP BY ROLLUP (p_brand, p_type)
""")
def part_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P9: rollup with grouping flags."""
    part = read_table(spark, sf_dir, "part").withColumn("price", cents("p_retailprice").cast("decimal(18,0)"))
    totals = {"n_parts": "*", "total_price": "price"}
    return rollup_totals(part, ["p_brand", "p_type"], totals).withColumn(
        "total_price", amount(F.col("total_price"), 100)
    )


@query("""
    SELECT p_brand, p_type,
           CAST(grouping(p_brand) AS INTEGER) AS p_brand_is_total,
           CAST(grouping(p_type) AS INTEGER) AS p_type_is_total,
           count(*) AS n_parts,
           CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DOUBLE) AS total_price
    FROM part GROUP BY CUBE (p_brand, p_type)
""")
def part_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P10: cube."""
    part = read_table(spark, sf_dir, "part").withColumn("price", cents("p_retailprice").cast("decimal(18,0)"))
    totals = {"n_parts": "*", "total_price": "price"}
    return rollup_totals(part, ["p_brand", "p_type"], totals, cube=True).withColumn(
        "total_price", amount(F.col("total_price"), 100)
    )


@query("""
    SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type
""")
def users_per_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P11: distinct count. Spark shuffles by (type, user) first, so a hot
    type is spread over its users."""
    return (
        read_table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.count_distinct("user_id").alias("n_users"))
    )


@query("""
    SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median_value
    FROM events GROUP BY event_type
""")
def median_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P12: exact median per group."""
    events = read_table(spark, sf_dir, "events")
    medians = exact_percentile(events, ["event_type"], "value", 0.5, "median_value")
    return medians.withColumn("median_value", F.round("median_value", 6))


@query("""
    SELECT user_id,
           sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS click,
           sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS error,
           sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS purchase,
           sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)::BIGINT AS signup,
           sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS view,
           sum(CASE WHEN event_type IN ('click', 'error', 'purchase', 'signup', 'view')
                    THEN 0 ELSE 1 END)::BIGINT AS other
    FROM events GROUP BY user_id
""")
def event_counts_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P13: pivot to columns. With the values known, a count per column
    needs one shuffle; ``pivot`` makes two, by (user, type) and then by user. Events of
    another kind or of none are counted as ``other``."""
    known = F.coalesce(F.col("event_type").isin(EVENT_TYPES), F.lit(False))
    return (
        read_table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(*[F.count_if(F.col("event_type") == kind).alias(kind) for kind in EVENT_TYPES],
             F.count_if(~known).alias("other"))
    )


@query("""
    SELECT c_nationkey, c_custkey, c_acctbal, rank FROM (
        SELECT c_nationkey, c_custkey, c_acctbal,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
        FROM customer)
    WHERE rank <= 3
""")
def top_customers_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P14: top-k per group."""
    customer = read_table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return top_per_group(
        customer, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3
    )


@query("""
    SELECT user_id, event_id, ts, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
        FROM events)
    WHERE n = 1
""")
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P29: latest row per key."""
    events = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return top_per_group(events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 1).drop("rank")


@query("""
    SELECT user_id,
           round(regr_slope(value, datediff('day', DATE '1970-01-01', CAST(ts AS DATE))), 6)
               AS value_per_day
    FROM events GROUP BY user_id
""")
def value_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P20: linear trend per key."""
    return (
        read_table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.round(F.regr_slope("value", day_number("ts")), 6).alias("value_per_day"))
    )
