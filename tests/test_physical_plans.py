"""What the plans must look like at scale, with automatic broadcasts off."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import asof_join, range_join, with_lookback
from tallyspan.operators.ordered import previous
from tallyspan.plans import QUERIES
from tallyspan.sources import read_table

# Shuffles of rows each query may make. Broadcasts are not counted.
SHUFFLES = {
    "filter_project": 0, "event_props": 0, "order_labels": 0, "embedding_lengths": 0,
    "orders_written_by_year": 0, "largest_orders": 0,
    "pricing_summary": 1, "event_counts_by_user": 1, "value_trend": 1, "median_value": 1,
    "hourly_events": 1, "top_customers_per_nation": 1, "latest_event_per_user": 1,
    "value_change": 1, "moving_average": 1, "events_in_last_day": 1, "user_sessions": 1,
    "event_type_runs": 1, "last_click_before_purchase": 1, "brands_in_small_and_large": 1,
    "users_per_event_type": 2, "filled_means": 2, "part_rollup": 2, "part_cube": 2, "sliding_hours": 2,
    "purchases_after_click": 2, "order_line_counts": 2, "orders_with_large_lines": 2,
    "orders_without_lines": 2, "parts_above_brand_average": 2,
    # The second copy of the first shuffle is reused when the job runs.
    "repeat_orders": 3,
    # Two sides of a join by order, equal intervals, and the window by customer.
    "customer_open_times": 4,
    # Four inputs of two joins, each made of two shuffles; reused when the job runs.
    "orders_open_together": 12,
    "region_revenue": 9,
}


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_shuffles(spark, no_broadcast, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"\bExchange (?!SinglePartition)", text)) <= SHUFFLES[name]
    for operator in ("CartesianProduct", "NestedLoopJoin", "SinglePartition", "Python", "InPandas"):
        assert operator not in text


def test_every_batch_query_has_a_bound():
    assert set(SHUFFLES) == {n for n in QUERIES if not n.startswith("stream_")}


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["filter_project"](spark, sf_dir), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for part in ("GreaterThanOrEqual(l_shipdate", "LessThan(l_shipdate", "GreaterThanOrEqual(l_discount",
                 "LessThanOrEqual(l_discount", "In(l_returnflag"):
        assert part in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "l_tax" not in schema and "l_comment" not in schema and "l_quantity" not in schema


@pytest.mark.parametrize("name", ["top_customers_per_nation", "latest_event_per_user"])
def test_top_rows_are_kept_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_star_join_sums_before_it_joins(spark, no_broadcast, sf_dir):
    text = plan(QUERIES["region_revenue"](spark, sf_dir))
    scan_of_lines = text[:text.index("l_extendedprice", text.rindex("FileScan parquet [l_orderkey"))]
    assert scan_of_lines.rindex("partial_sum") > scan_of_lines.rindex("SortMergeJoin [l_orderkey")


def test_structs_stay_out_of_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["last_click_before_purchase"](spark, sf_dir))
    assert "struct(" not in text[text.index("Exchange"):]


def test_split_keys_shuffle_their_rows_once(spark, sf_dir):
    """The rows by key and segment once; beside them counts, and rows kept by a group limit."""
    events = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    split = with_lookback(events, ["user_id"], ["ts", "event_id"], 1, {"b": previous("value")}, 64)
    text = plan(split)
    whole = re.findall(r"\bExchange hashpartitioning\(user_id#\d+L?, __segment#\d+,.*\n[^\n]*Union", text)
    assert len(whole) == 1
    limits = re.findall(r"WindowGroupLimit [^\n]*Partial", text)
    assert len(limits) == 1
    assert len(re.findall(r"\bExchange ", text)) - len(whole) <= 4


def test_a_wide_right_row_is_in_no_broadcast(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    left = events.select("user_id", "ts", "event_id")
    right = events.select("user_id", F.col("ts").alias("r_ts"), F.col("event_id").alias("r_id"), F.repeat("props", 1000).alias("wide"))
    joined = asof_join(left, right, ["user_id"], ("ts", "event_id"), ("r_ts", "r_id"), rows_per_segment=64)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                if below.strip() and len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
                assert "wide" not in below and "props" not in below


def test_a_hot_hour_is_spread_over_buckets(spark):
    """One user's clicks and purchases of one hour meet in several buckets, and Spark splits
    the join where one is still hot."""
    clicks = spark.range(4000).selectExpr("1 AS user_id", "id AS l", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 0.9) AS lt")
    buys = spark.range(4000).selectExpr("1 AS user_id", "id AS r", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 0.9) AS rt")
    pairs = range_join(clicks, buys, ["user_id"], "lt", "rt", "1 hour")
    assert pairs.count() == 4000 * 4001 // 2
    spread = clicks.select(F.window("lt", f"{3600 * 10**6 // 4} microseconds")["start"]).distinct().count()
    assert spread == 4
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        split = range_join(clicks.repartition(16), buys.repartition(16), ["user_id"], "lt", "rt", "1 hour")
        split.collect()
        assert "skew=true" in split._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_few_averages_are_broadcast(spark, no_broadcast, sf_dir):
    text = plan(QUERIES["parts_above_brand_average"](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
