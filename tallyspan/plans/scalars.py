"""Functions of one row, and the Parquet sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import squared_length
from tallyspan.plans.registry import query
from tallyspan.sources import read_table, run_folder, write_table


@query("""
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P25: field from a JSON string."""
    return read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month,
           CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_rank,
           upper(substring(o_orderpriority, 3, 4)) AS priority_code,
           CAST(quarter(o_orderdate) AS INTEGER) AS order_quarter
    FROM orders
""")
def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P27: date and string functions."""
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.substring(F.to_date("o_orderdate").cast("string"), 1, 7).alias("order_month"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("int").alias("priority_rank"),
        F.upper(F.substring("o_orderpriority", 3, 4)).alias("priority_code"),
        F.quarter("o_orderdate").alias("order_quarter"),
    )


@query("""
    SELECT vec_id, label,
           round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6)
               AS squared_length
    FROM embeddings
""")
def embedding_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P28: array transform and fold."""
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.round(squared_length("embedding"), 6).alias("squared_length")
    )


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CAST(year(o_orderdate) AS INTEGER) AS order_year
    FROM orders
""")
def orders_written_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional P35: write Parquet partitioned by year, and read it back."""
    folder = run_folder(spark, "orders-by-year")
    orders = read_table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    write_table(orders, folder, partition_by=["order_year"], sort_by=["o_orderdate"])
    return spark.read.schema(orders.schema).parquet(folder)
