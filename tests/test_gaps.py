"""Filling a regular grid: brute force with nulls, ties, repeated rows, hot keys, long gaps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import gaps, regular_grid

START = dt.datetime(2024, 3, 10)
HOUR = dt.timedelta(hours=1)
SCHEMA = "key bigint, ts timestamp_ntz, value bigint"


def brute(rows, width):
    """{(key, step): (rows, sum)} with the gaps on straight lines."""
    held = {}
    for key, ts, value in rows:
        if ts is not None:
            at = dt.datetime(1970, 1, 1) + (ts - dt.datetime(1970, 1, 1)) // width * width
            held.setdefault((key, at), []).append(value)
    sums = {}
    for place, values in held.items():
        there = [v for v in values if v is not None]
        sums[place] = float(sum(there)) if there else None
    out = {place: (len(held[place]), sums[place]) for place in held}
    for key in {k for k, _ in held}:
        times = sorted(t for k, t in held if k == key)
        for a, b in zip(times, times[1:], strict=False):
            steps, x, y = (b - a) // width, sums[key, a], sums[key, b]
            for k in range(1, steps):
                out[key, a + k * width] = (0, None if x is None or y is None else x + (y - x) * (k / steps))
    return out


def got(df):
    rows = df.collect()
    found = {(r["key"], r["grid_time"]): (r["n_rows"], r["total"]) for r in rows}
    assert len(found) == len(rows)
    return found


def make_rows(seed, n=1500):
    """Key 1 is hot, so is the null key; rows repeat, and some have no time or no value."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        key = draw.choices([1, None, draw.randrange(2, 40)], [40, 20, 40])[0]
        ts = None if draw.random() < 0.02 else START + dt.timedelta(seconds=draw.randrange(400 * 3600))
        rows.append((key, ts, None if draw.random() < 0.05 else draw.randrange(1000)))
    return rows + rows[:50]


@pytest.mark.parametrize("segment", [64, 10**6])
@pytest.mark.parametrize("block", [4096, 3])
@pytest.mark.parametrize("step,width", [("1 hour", HOUR), ("90 minutes", 1.5 * HOUR)])
def test_equals_brute_force(spark, monkeypatch, segment, block, step, width):
    monkeypatch.setattr(gaps, "STEPS_PER_BLOCK", block)
    rows = make_rows(segment + block)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    grid = regular_grid(frame, ["key"], "ts", step, {"total": F.sum("value")}, rows_per_segment=segment)
    assert got(grid) == brute(rows, width)


def test_the_session_zone_does_not_matter(spark):
    """In New York the clock leaps forward at 2 o'clock on this day."""
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = [(1, START, 10), (1, START + 6 * HOUR, 70)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        grid = regular_grid(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", "1 hour", {"total": F.sum("value")})
        assert got(grid) == {(1, START + k * HOUR): (int(k in (0, 6)), 10.0 + 10 * k) for k in range(7)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_long_gap_holds_no_long_array(spark):
    rows = [(1, START, 0), (1, START + dt.timedelta(seconds=1_000_000), 1_000_000)]
    grid = regular_grid(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", "1 second", {"total": F.sum("value")})
    facts = grid.agg(F.count(F.lit(1)), F.sum("n_rows"), F.count_distinct("grid_time"), F.max("total")).first()
    assert tuple(facts) == (1_000_001, 2, 1_000_001, 1_000_000.0)


def test_no_rows_one_row_and_clashing_columns(spark):
    values = {"total": F.sum("value")}
    empty = regular_grid(spark.createDataFrame([], SCHEMA), ["key"], "ts", "1 day", values)
    assert empty.collect() == [] and empty.columns == ["key", "grid_time", "n_rows", "total"]
    one = spark.createDataFrame([(None, START, None, 5, 6)], SCHEMA + ", n_rows int, total int")
    assert got(regular_grid(one, ["key"], "ts", "1 day", values)) == {(None, START): (1, None)}
    with pytest.raises(ValueError):
        regular_grid(one, ["key"], "ts", "0 seconds", values)
