"""Operators that need no segments, with nulls and duplicates the fixtures lack."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspan.functions import amount, as_instant, as_wall_clock, cents, discounted, exact_sum, squared_length
from tallyspan.operators import (
    except_all,
    intersect_distinct,
    range_join,
    rollup_totals,
    sets,
    top_per_group,
)

START = dt.datetime(2024, 1, 1)


def test_except_all_with_many_copies(spark, monkeypatch):
    monkeypatch.setattr(sets, "_COPIES", 16)
    rng = random.Random(1)
    left = [(rng.choices([7, None, rng.randrange(20)], [40, 10, 50])[0],) for _ in range(900)]
    right = [(rng.choices([7, None, rng.randrange(25)], [10, 20, 70])[0],) for _ in range(300)]
    got = except_all(
        spark.createDataFrame(left, "k bigint"), spark.createDataFrame(right, "other bigint")
    )
    assert Counter(r[0] for r in got.collect()) == Counter(x[0] for x in left) - Counter(x[0] for x in right)
    plain = spark.createDataFrame(left, "k bigint").exceptAll(spark.createDataFrame(right, "k bigint"))
    assert Counter(r[0] for r in got.collect()) == Counter(r[0] for r in plain.collect())


def test_intersect_matches_nulls(spark):
    left = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (None,), (None,), (3,)], "k int")
    assert {r[0] for r in intersect_distinct(left, right).collect()} == {1, None}
    assert intersect_distinct(left, right).count() == 2


@pytest.mark.parametrize("span", ["1 hour", "90 seconds", "2 days"])
def test_range_join(spark, span):
    length = {"1 hour": 3600, "90 seconds": 90, "2 days": 172800}[span]
    rng = random.Random(5)

    def side(n):
        return [
            (rng.choice([1, 1, 1, 2, 3, None]), i, START + dt.timedelta(seconds=rng.randrange(0, 8 * 3600, 15)))
            for i in range(n)
        ]

    left, right = side(200), [*side(200), (1, 900, None)]
    got = range_join(
        spark.createDataFrame(left, "k int, l int, l_ts timestamp_ntz"),
        spark.createDataFrame(right, "k int, r int, r_ts timestamp_ntz"),
        ["k"], "l_ts", "r_ts", span,
    )
    assert got.columns == ["k", "l", "l_ts", "r", "r_ts"]
    expected = sorted(
        (a[1], b[1]) for a in left for b in right
        if a[0] is not None and a[0] == b[0] and b[2] is not None
        and 0 <= (b[2] - a[2]).total_seconds() <= length
    )
    assert sorted((r.l, r.r) for r in got.collect()) == expected


def test_top_per_group(spark):
    rows = [(i % 3 or None, i) for i in range(50)]
    got = top_per_group(spark.createDataFrame(rows, "g int, v int"), ["g"], [F.desc("v")], 2)
    assert sorted((r.g or 0, r.v, r.rank) for r in got.collect()) == [
        (0, 45, 2), (0, 48, 1), (1, 46, 2), (1, 49, 1), (2, 44, 2), (2, 47, 1),
    ]


@pytest.mark.parametrize("cube", [False, True])
def test_rollup_tells_a_null_from_a_total(spark, cube):
    df = spark.createDataFrame(
        [("x", None, 1), ("x", "b", 2), (None, "b", 4), ("x", "b", 8)], "a string, b string, v int"
    )
    got = rollup_totals(df, ["a", "b"], {"n": "*", "total": "v"}, cube)
    plain = (df.cube("a", "b") if cube else df.rollup("a", "b")).agg(
        F.grouping("a").cast("int").alias("a_is_total"), F.grouping("b").cast("int").alias("b_is_total"),
        F.count("*").alias("n"), F.sum("v").alias("total"),
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_clock_ignores_the_session_zone(spark, zone):
    times = ["1969-12-31 23:59:59.000001", "2024-03-10 02:30:00.5", "2024-11-03 01:30:00", "2024-06-01 12:00:00.999999"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in times], "t string").select(
            F.col("t").cast("timestamp_ntz").alias("t")
        )
        instant = as_instant("t")
        rows = df.select("t", as_wall_clock(instant).alias("back"), F.unix_micros(instant).alias("us")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r in rows:
        assert r.back == r.t
        assert r.us == (r.t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def test_scalar_functions(spark):
    row = spark.createDataFrame([(10.05, 0.07, [1.0, 2.0, -2.0])], "p double, d double, v array<float>").select(
        cents("p").alias("c"), discounted("p", "d").alias("r"), squared_length("v").alias("s")
    )
    assert row.dtypes == [("c", "bigint"), ("r", "bigint"), ("s", "double")]
    assert tuple(row.first()) == (1005, 93465, 9.0)


def test_sums_of_money_are_exact(spark):
    """A thousand tenths, and a sum beyond what a long holds."""
    df = spark.createDataFrame([(0.1, 9 * 10**17)] * 1000, "p double, u bigint")
    row = df.agg(amount(exact_sum(cents("p")), 100).alias("p"), exact_sum("u").alias("u")).first()
    assert row.p == 100.0
    assert int(row.u) == 9 * 10**20
