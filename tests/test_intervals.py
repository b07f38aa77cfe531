"""Overlap join: brute force with nulls, ties, repeated rows, a hot key, very long intervals."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import intervals, overlap_join

START = dt.datetime(1969, 12, 30)
LEFT = "key bigint, l bigint, l_from timestamp_ntz, l_to timestamp_ntz"
RIGHT = "key bigint, r bigint, r_from timestamp_ntz, r_to timestamp_ntz"


def make_rows(seed, n):
    """Lengths from nothing to years; key 1 is hot; null keys and ends; ends before starts."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        key = draw.choices([1, None, draw.randrange(2, 9)], [40, 10, 50])[0]
        first = START + dt.timedelta(seconds=draw.randrange(400) * draw.choice([1, 600, 3600]))
        last = first + dt.timedelta(seconds=draw.choice([0, 1, 59, 60, 61, 3600, 90_000, 10**8, -5]) * draw.choice([1, 1, 3]))
        rows.append((key, i, None if draw.random() < 0.03 else first, None if draw.random() < 0.03 else last))
    return rows + rows[:20]


def brute(left, right):
    good = lambda r: None not in (r[0], r[2], r[3]) and r[2] <= r[3]
    return sorted((a[1], b[1]) for a in left if good(a) for b in right
                  if good(b) and a[0] == b[0] and a[2] <= b[3] and b[2] <= a[3])


@pytest.mark.parametrize("finest", ["1 second", "1 minute", "30 days"])
def test_equals_brute_force(spark, finest):
    left, right = make_rows(1, 400), make_rows(2, 300)
    pairs = overlap_join(spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT),
                         ["key"], ("l_from", "l_to"), ("r_from", "r_to"), finest)
    assert pairs.columns == ["key", "l", "l_from", "l_to", "r", "r_from", "r_to"]
    assert sorted((r["l"], r["r"]) for r in pairs.collect()) == brute(left, right)


def test_no_rows(spark):
    some = spark.createDataFrame(make_rows(3, 20), LEFT)
    none = spark.createDataFrame([], RIGHT)
    assert overlap_join(some, none, ["key"], ("l_from", "l_to"), ("r_from", "r_to")).collect() == []
    with pytest.raises(ValueError):
        overlap_join(some, none, ["key"], ("l_from", "l_to"), ("r_from", "r_to"), "0 seconds")


def test_a_long_interval_has_few_copies(spark):
    """Ten years over buckets of a second: two copies a level, not 315 million."""
    rows = spark.createDataFrame(
        [(1, 1, START, START + dt.timedelta(days=3652)), (1, 2, START, START + dt.timedelta(seconds=3))], LEFT)
    base = 10**6
    levelled = intervals._levelled(rows, ("l_from", "l_to"), base, "l")
    levels = [F.lit(n) for n in range(0, 18)]
    copies = {r["l"]: r["count"] for r in intervals._copies(levelled, "l", base, levels).groupBy("l").count().collect()}
    assert copies[1] <= 2 * 4 and copies[2] <= 2 * 18
    own = intervals._copies(levelled, "l", base, [F.col("__l_level")]).groupBy("l").count().collect()
    assert all(r["count"] <= 2 for r in own)
