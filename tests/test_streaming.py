"""Streams over several files and batches, with late rows, copies and restarts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspan.sources import SCHEMAS, read_table, run_folder, stream_files, stream_table, write_table
from tallyspan.streaming import first_deliveries, run_available, session_counts, window_counts
from tallyspan.streaming.dedupe import spans_before

START = dt.datetime(2024, 3, 1)
HOUR = dt.timedelta(hours=1)


def event(i, minutes, user=1, kind="view"):
    return (i, START + dt.timedelta(minutes=minutes), user, kind, 1.0, "{}")


def arrive(spark, folder, rows):
    """Rows arrive as one file."""
    spark.createDataFrame(rows, SCHEMAS["events"]).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder(spark):
    return run_folder(spark, "test")


def test_windows_over_many_batches_equal_one(spark, folder, sf_dir):
    """The same events in eight files, read one per batch, and in a single batch."""
    events = read_table(spark, sf_dir, "events")
    for part in range(8):
        events.where(f"event_id >= {part * 1250} AND event_id < {(part + 1) * 1250}").coalesce(1).write.mode(
            "append"
        ).parquet(f"{folder}/in")
    results = []
    for name, files in (("one", None), ("many", 1)):
        stream = stream_files(spark, f"{folder}/in", "events", files_per_trigger=files)
        counts = window_counts(stream, "ts", "1 hour", "10 minutes", ["event_type"])
        results.append(sorted(map(tuple, run_available(counts, f"{folder}/{name}").collect())))
        if files:
            assert spark.read.text(f"{folder}/{name}/checkpoint/offsets").count() >= 8
    assert results[0] == results[1]
    assert sum(r[3] for r in results[0]) > 9900


def test_late_rows_are_taken_until_the_window_closes(spark, folder):
    def run():
        stream = stream_files(spark, f"{folder}/in", "events")
        counts = window_counts(stream, "ts", "1 hour", "30 minutes")
        rows = run_available(counts, f"{folder}/out").collect()
        return {(r.window_start - START) // HOUR: r.n for r in rows}

    arrive(spark, f"{folder}/in", [event(1, 10), event(2, 85)])
    assert run() == {}  # the first hour waits until 01:30
    arrive(spark, f"{folder}/in", [event(3, 20), event(4, 100)])
    assert run() == {0: 2}  # row 3 is late and in time
    arrive(spark, f"{folder}/in", [event(5, 30), event(6, 70), event(7, 160)])
    assert run() == {0: 2, 1: 3}  # row 5 is too late, row 6 is not


def test_sessions_across_restarts(spark, folder):
    def run():
        stream = stream_files(spark, f"{folder}/in", "events")
        counts = session_counts(stream, "ts", "30 minutes", "10 minutes", ["user_id"])
        rows = run_available(counts, f"{folder}/out").collect()
        return sorted((r.user_id, (r.session_start - START).seconds // 60, (r.session_end - START).seconds // 60, r.n) for r in rows)

    arrive(spark, f"{folder}/in", [event(1, 0), event(2, 20), event(3, 5, user=2)])
    assert run() == []
    arrive(spark, f"{folder}/in", [event(4, 45), event(5, 60, user=2)])
    assert run() == [(2, 5, 35, 1)]
    arrive(spark, f"{folder}/in", [event(6, 200, user=3)])
    assert run() == [(1, 0, 75, 3), (2, 5, 35, 1), (2, 60, 90, 1)]


def deliver(spark, folder, rows):
    arrive(spark, f"{folder}/in", rows)
    stream = stream_files(spark, f"{folder}/in", "events", files_per_trigger=1)
    return first_deliveries(stream, ["event_id"], "ts", f"{folder}/out").collect()


def test_first_deliveries_with_a_hot_event(spark, folder):
    """One event is half of all rows, within and across batches."""
    rng = random.Random(8)
    ids = list(range(60))
    first = [event(i, i) for i in ids for _ in range(rng.randrange(1, 4))] + [event(7, 7)] * 400
    rng.shuffle(first)
    second = [event(i, i) for i in ids[30:]] + [event(7, 7)] * 200 + [event(60, 61)]
    results = [deliver(spark, folder, rows) for rows in (first, second)]
    assert Counter(r.event_id for r in results[0]) == Counter(ids)
    assert Counter(r.event_id for r in results[1]) == Counter([*ids, 60])
    assert all(r.ts == START + dt.timedelta(minutes=r.event_id) for r in results[1] if r.event_id < 60)


def test_deliveries_that_come_late_are_kept(spark, folder):
    """A row far behind the others is delivered once, and again: it comes out once."""
    for hours in (100, 101, 50, 102, 50):
        rows = deliver(spark, folder, [event(hours, hours * 60), (None, None, hours, "view", 1.0, "{}")])
    assert Counter(r.event_id for r in rows) == Counter([100, 101, 50, 102, None])


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_spans_hold_every_earlier_batch_once_and_are_few(fan):
    written = set()
    for number in range(1200):
        spans = spans_before(number, fan)
        assert [b for first, end in spans for b in range(first, end)] == list(range(number))
        assert all(end - first == 1 or (first, end) in written for first, end in spans)
        lengths = Counter(end - first for first, end in spans)
        assert all(n < fan for n in lengths.values())
        size = fan
        while (number + 1) % size == 0:
            written.add((number + 1 - size, number + 1))
            size *= fan


def test_deliveries_over_many_batches(spark, folder):
    """30 batches, keys merged by threes: copies come back after any number of batches."""
    rng, sent = random.Random(4), []
    for _ in range(30):
        again = rng.sample(sent, min(len(sent), 5))
        # A new event, a hot one, one without a time and one without a key, and copies.
        rows = [event(len(sent) + 1000, len(sent) * 700), event(7, 7), (8, None, 1, "view", 1.0, "{}"),
                (None, START, 1, "view", 1.0, "{}"), *again]
        sent += [r for r in rows if r not in sent]
        arrive(spark, f"{folder}/in", rows)
    stream = stream_files(spark, f"{folder}/in", "events", files_per_trigger=1)
    got = first_deliveries(stream, ["event_id"], "ts", f"{folder}/out", fan=3)
    assert Counter(map(tuple, got.collect())) == Counter(sent)
    assert spark.read.text(f"{folder}/out/checkpoint/offsets").count() >= 30
    # The keys of the first 27 batches are one table, by day.
    merged = spark.read.parquet(f"{folder}/out/keys/__span=from-0-to-27")
    assert merged.count() == 30 and "__day" in merged.columns
    one = merged.where("__day = DATE '2024-03-01'").select("event_id")
    assert "PartitionFilters: [isnotnull(__day" in one._jdf.queryExecution().toString()
    # With more copies and the same folder it goes on.
    arrive(spark, f"{folder}/in", [*sent[::7], event(9999, 1)])
    stream = stream_files(spark, f"{folder}/in", "events", files_per_trigger=1)
    got = first_deliveries(stream, ["event_id"], "ts", f"{folder}/out", fan=3)
    assert Counter(map(tuple, got.collect())) == Counter([*sent, event(9999, 1)])


def test_a_batch_of_very_many_days_loses_no_copy(spark, folder):
    many = [event(i, i * 1440) for i in range(1100)]
    assert len(deliver(spark, folder, many)) == 1100
    assert len(deliver(spark, folder, [*many, event(5000, 0)])) == 1101


def test_a_key_on_another_day_is_another_row(spark, folder):
    assert len(deliver(spark, folder, [event(1, 0), event(1, 0), event(1, 1440)])) == 2
    assert len(deliver(spark, folder, [event(1, 1440), event(1, 2880)])) == 3


def test_a_stream_without_input_gives_no_rows(spark, folder):
    spark.createDataFrame([], SCHEMAS["events"]).write.parquet(f"{folder}/in")
    stream = stream_files(spark, f"{folder}/in", "events").where("event_id < 0")
    assert first_deliveries(stream, ["event_id"], "ts", f"{folder}/out").collect() == []


def test_repeated_rows_are_dropped_in_the_map_tasks(spark, sf_dir):
    rows = read_table(spark, sf_dir, "events").dropDuplicates(["event_id"])
    text = rows._jdf.queryExecution().toString()
    assert text.index("Exchange hashpartitioning") < text.rindex("partial_first") and "Python" not in text


def test_a_folder_of_files_gives_the_rows_of_one_file(spark, folder, sf_dir):
    """Each stream query over eight files in several batches, and over the single file."""
    from tallyspan.plans import QUERIES

    events = read_table(spark, sf_dir, "events")
    for part in range(8):
        events.where(f"event_id >= {part * 1250} AND event_id < {(part + 1) * 1250}").coalesce(1).write.mode(
            "append").parquet(f"{folder}/events.parquet")
    for name in sorted(n for n in QUERIES if n.startswith("stream_")):
        one = sorted(map(tuple, QUERIES[name](spark, sf_dir).collect()))
        many = sorted(map(tuple, QUERIES[name](spark, folder).collect()))
        assert one == many and one, name
    stream = stream_table(spark, folder, "events", files_per_trigger=2)
    counts = window_counts(stream, "ts", "1 hour", "10 minutes", ["event_type"])
    rows = run_available(counts, f"{folder}/two").collect()
    assert spark.read.text(f"{folder}/two/checkpoint/offsets").count() >= 4
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["stream_hourly_events"](spark, sf_dir).collect()))


def test_a_second_call_with_the_folder_goes_on(spark, folder, sf_dir):
    from tallyspan.plans import QUERIES

    events = read_table(spark, sf_dir, "events")
    events.where("event_id < 5000").coalesce(1).write.parquet(f"{folder}/events.parquet")
    for name in ("stream_hourly_events", "stream_first_deliveries"):
        first = QUERIES[name](spark, folder, f"{folder}/{name}").count()
        assert QUERIES[name](spark, folder, f"{folder}/{name}").count() == first > 0
    events.where("event_id >= 5000").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    for name in ("stream_hourly_events", "stream_first_deliveries"):
        got = QUERIES[name](spark, folder, f"{folder}/{name}")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, QUERIES[name](spark, sf_dir).collect()))


def test_without_a_shared_folder_the_error_says_what_to_set():
    from tallyspan.sources import shared_folder

    class Bare:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Bare)


def test_partitioned_table_prunes_and_keeps_every_row(spark, folder, sf_dir):
    orders = read_table(spark, sf_dir, "orders").selectExpr("*", "year(o_orderdate) AS y")
    write_table(orders, folder, partition_by=["y"], sort_by=["o_orderdate"])
    back = spark.read.parquet(folder)
    assert back.count() == orders.count()
    assert back.exceptAll(orders.select(back.columns)).count() == 0
    # One task writes a year here, so a year is one file.
    assert len(back.inputFiles()) == orders.select("y").distinct().count()
    one = back.where("y = 1996").select("o_orderkey")
    text = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(y" in text and "(y#" in text.split("PartitionFilters")[1]
    assert one.select(F.input_file_name()).distinct().count() == 1
    with pytest.raises(Exception, match="already exists"):
        write_table(orders, folder, partition_by=["y"])
