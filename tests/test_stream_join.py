"""Two streams joined: many batches, matches that come late, unmatched rows, restarts, a hot key."""

import datetime as dt
import random

import pytest

from tallyspan.sources import SCHEMAS, run_folder, stream_files
from tallyspan.streaming import join_within, run_available

START = dt.datetime(2024, 3, 1)


def event(i, minutes, user=1, kind="click"):
    at = None if minutes is None else START + dt.timedelta(minutes=minutes)
    return (i, at, user, kind, 1.0, "{}")


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMAS["events"]).coalesce(1).write.mode("append").parquet(folder)


def joined(spark, folder, how="left"):
    def kind(name, prefix):
        stream = stream_files(spark, f"{folder}/in", "events", files_per_trigger=1)
        return stream.where(f"event_type = '{name}'").selectExpr(
            "user_id", f"event_id AS {prefix}_id", f"ts AS {prefix}_ts")
    pairs = join_within(kind("click", "c"), kind("purchase", "p"), ["user_id"], "c_ts", "p_ts", "1 hour", "10 minutes", how)
    rows = run_available(pairs, f"{folder}/out").collect()
    return sorted(((r["c_id"], r["p_id"]) for r in rows), key=str)


def test_matches_wait_and_lonely_rows_come_last(spark):
    folder = run_folder(spark, "join")
    arrive(spark, f"{folder}/in", [event(1, 0), event(2, 30), event(3, 5, kind="purchase"), event(4, None), event(5, 1, user=None)])
    assert joined(spark, folder) == [(1, 3)]  # click 2 may still be matched
    arrive(spark, f"{folder}/in", [event(6, 90, kind="purchase"), event(7, 60, kind="purchase"), event(8, 95)])
    assert joined(spark, folder) == [(1, 3), (1, 7), (2, 6), (2, 7)]  # both ends belong to the span
    arrive(spark, f"{folder}/in", [event(9, 400), event(10, 400, kind="purchase"), event(11, 401, kind="purchase")])
    assert joined(spark, folder) == sorted([(1, 3), (1, 7), (2, 6), (2, 7), (8, None), (9, 10), (9, 11)], key=str)
    arrive(spark, f"{folder}/in", [event(12, 96, kind="purchase"), event(13, 402)])
    assert (8, 12) not in joined(spark, folder)  # too late


@pytest.mark.parametrize("how", ["inner", "left"])
def test_many_batches_equal_brute_force(spark, how):
    folder, draw = run_folder(spark, "join"), random.Random(5)
    rows = [event(i, i // 2, draw.choices([1, draw.randrange(2, 9)], [1, 2])[0], draw.choice(["click", "purchase"]))
            for i in range(900)]
    rows += [event(2000, 2000, 99), event(2001, 2000, 98, "purchase")]
    rows += rows[:3]  # repeated rows, in the first file
    files = [rows[:300] + rows[-3:], rows[300:600], rows[600:-3]]
    for part in files:
        arrive(spark, f"{folder}/in", draw.sample(part, len(part)))
    found = joined(spark, folder, how)
    clicks, buys = ([r for r in rows if r[3] == k] for k in ("click", "purchase"))
    hour = dt.timedelta(hours=1)
    expected = []
    for c in clicks:
        ids = [p[0] for p in buys if p[2] == c[2] and c[1] <= p[1] <= c[1] + hour]
        alone = [None] if how == "left" and not ids and c[0] != 2000 else []
        expected += [(c[0], p) for p in ids or alone]
    assert found == sorted(expected, key=str)
