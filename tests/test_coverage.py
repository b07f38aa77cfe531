"""Union of intervals: brute force with nulls, ties, repeated rows and hot keys in many segments."""

import random

import pytest

from tallyspan.operators import interval_union

SCHEMA = "key bigint, first bigint, last bigint"


def make_rows(seed, spread, n=2500):
    """Key 1 is hot, so is the null key; short intervals, and a few that span many segments."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        key = draw.choices([1, None, draw.randrange(2, 40)], [40, 20, 40])[0]
        first = draw.randrange(spread)
        length = draw.choice([0, 1, 5, 20, -3]) if draw.random() < 0.99 else spread // 4
        rows.append((key, None if draw.random() < 0.02 else first, None if draw.random() < 0.02 else first + length))
    return rows + rows[:200]


def brute(rows):
    out = []
    for key in {r[0] for r in rows}:
        good = sorted((a, b) for k, a, b in rows if k == key and None not in (a, b) and a <= b)
        stretch = None
        for a, b in good:
            if stretch and a <= stretch[1]:
                stretch = [stretch[0], max(b, stretch[1]), stretch[2] + 1]
            else:
                if stretch:
                    out.append((key, *stretch))
                stretch = [a, b, 1]
        if stretch:
            out.append((key, *stretch))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [64, 400, 10**6])
@pytest.mark.parametrize("spread", [300, 20_000, 200_000])
def test_equals_brute_force(spark, segment, spread):
    rows = make_rows(segment + spread, spread)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    union = interval_union(frame, ["key"], ("first", "last"), segment)
    assert union.columns == ["key", "covered_from", "covered_to", "n_rows"]
    assert sorted((tuple(r) for r in union.collect()), key=str) == brute(rows)


def test_one_interval_over_every_segment(spark):
    """The stretch that segment 0 begins reaches over all the others."""
    rows = [(1, 0, 10_000)] + [(1, i, i) for i in range(0, 9_000, 3)] + [(1, 10_001, 10_002)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = interval_union(frame, ["key"], ("first", "last"), 64).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 10_000, 3001), (1, 10_001, 10_002, 1)]


def test_no_rows_and_nothing_usable(spark):
    for rows in ([], [(1, 5, 4), (1, None, 3), (None, 3, None)]):
        assert interval_union(spark.createDataFrame(rows, SCHEMA), ["key"], ("first", "last")).collect() == []
