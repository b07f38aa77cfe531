"""Filters, joins, set operations and sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import amount, discounted, exact_sum
from tallyspan.operators import except_all, intersect_distinct
from tallyspan.plans.registry import query
from tallyspan.sources import read_table


# Averages of a few dozen bytes that are sent to every task.
MOST_AVERAGES = 100_000


@query("""
    SELECT l_orderkey, l_partkey, l_shipdate, l_returnflag, l_discount,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))
                AS DECIMAL(18,4)) AS DOUBLE) AS revenue
    FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
      AND l_discount BETWEEN 0.02 AND 0.06
      AND l_returnflag IN ('A', 'R')
""")
def filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P1: range, between and in predicates, all pushed to the scan."""
    shipped = F.col("l_shipdate")
    return (
        read_table(spark, sf_dir, "lineitem")
        .where(
            (shipped >= F.lit("1997-01-01").cast("timestamp_ntz"))
            & (shipped < F.lit("1998-01-01").cast("timestamp_ntz"))
            & F.col("l_discount").between(0.02, 0.06)
            & F.col("l_returnflag").isin("A", "R")
        )
        .select(
            "l_orderkey", "l_partkey", "l_shipdate", "l_returnflag", "l_discount",
            (discounted("l_extendedprice", "l_discount") / 10_000.0).alias("revenue"),
        )
    )


@query("""
    SELECT r_name, count(DISTINCT o_orderkey) AS n_orders, count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))))
                AS DOUBLE) AS revenue
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
""")
def region_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P3: five-table star join with aggregate.

    Lines are summed per order before the first join, orders per customer before the
    second and customers per nation before the third, each on the key the join
    shuffles by anyway. A hot order, customer or nation is one row by the time it is
    joined. No side is forced to be broadcast; the planner does so under its threshold.
    """
    per_order = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            exact_sum(discounted("l_extendedprice", "l_discount")).alias("revenue"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(
            F.sum("revenue").cast("decimal(34,0)").alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
            F.count(F.lit(1)).alias("n_orders"),
        )
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(
            F.sum("revenue").cast("decimal(38,0)").alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
            F.sum("n_orders").alias("n_orders"),
        )
    )
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (
        per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(
            F.sum("n_orders").alias("n_orders"),
            F.sum("n_lines").alias("n_lines"),
            amount(F.sum("revenue"), 10_000).alias("revenue"),
        )
    )


@query("""
    SELECT o_orderkey, count(l_orderkey) AS n_lines
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY o_orderkey
""")
def order_line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P4: left outer join with a count of matches. Lines are counted
    before the join, so it has one row a side."""
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey")
        .join(lines, "o_orderkey", "left")
        .select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"))
    )


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 48)
""")
def orders_with_large_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P5: semi join. The keys are made distinct in the map tasks, on the
    partitioning the join needs."""
    large = (
        read_table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") >= 48)
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.join(large, "o_orderkey", "left_semi")


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P6: anti join."""
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(lines, "o_orderkey", "left_anti")


@query("""
    SELECT p_brand FROM part WHERE p_size <= 10
    INTERSECT
    SELECT p_brand FROM part WHERE p_size >= 40
""")
def brands_in_small_and_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P23: intersect."""
    part = read_table(spark, sf_dir, "part")
    return intersect_distinct(
        part.where(F.col("p_size") <= 10).select("p_brand"),
        part.where(F.col("p_size") >= 40).select("p_brand"),
    )


@query("""
    SELECT o_custkey AS custkey FROM orders
    EXCEPT ALL
    SELECT c_custkey AS custkey FROM customer
""")
def repeat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P24: except, duplicates kept: each customer's orders less the first."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    customer = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    return except_all(orders, customer)


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def largest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P26: global top-k, as a top 20 per task and then overall."""
    return (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(20)
    )


@query("""
    SELECT p_partkey, p_brand, p_retailprice FROM part p
    WHERE CAST(p_retailprice AS DECIMAL(12,2)) * (SELECT count(p_retailprice) FROM part q WHERE q.p_brand = p.p_brand)
        > (SELECT sum(CAST(p_retailprice AS DECIMAL(12,2))) FROM part q WHERE q.p_brand = p.p_brand)
""")
def parts_above_brand_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P30: correlated scalar subquery, as an aggregate and a join. The
    quotient has 18 places, so a price that differs from the average does so in the
    quotient too. The averages are counted first, and broadcast if they are few."""
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    averages = parts.groupBy("p_brand").agg(
        (F.sum(price) / F.count("p_retailprice")).alias("__average"))
    if averages.count() <= MOST_AVERAGES:
        averages = F.broadcast(averages)
    return parts.join(averages, "p_brand").where(price > F.col("__average")).select(
        "p_partkey", "p_brand", "p_retailprice")
