"""Line dedup against its SQL and brute force, and its edge cases."""

import hashlib
import random
from collections import Counter

import duckdb

from tallyspan.llm import lines
from tallyspan.llm.lines import boilerplate, drop_boilerplate
from tallyspan.llm.queries import ORACLES, QUERIES

PAGES = "doc_id bigint, text string, host string"


def brute(rows, ratio, least):
    pages, lines = Counter(h for _, _, h in rows), Counter()
    for _, text, host in rows:
        lines.update({(host, x.strip(" ")) for x in (text or "").split("\n") if x.strip(" ")} if text is not None else ())
    gone = {k for k, n in lines.items() if n >= least and n > ratio * pages[k[0]]}
    return [(i, None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(" ")) not in gone), h)
            for i, t, h in rows]


def test_against_brute_force_with_a_hot_host_nulls_and_blanks(frame):
    draw = random.Random(1)
    line = lambda: draw.choice(["menu", " menu ", "", "  ", "login", "a b", f"own {draw.randrange(500)}", "Ü", "\t"])
    rows = [(i, "\n".join(line() for _ in range(draw.randrange(1, 9))), draw.choice(["hot"] * 6 + ["h1", "h2", None]))
            for i in range(300)]
    rows += [(400, None, "hot"), (401, "", "h1"), (402, "menu", None), (None, "menu\nmenu", "h2"), (None, "menu\nmenu", "h2")]
    rows += [(500, "menu\n" * 20_000, "h1"), (501, "only page", "h9")]
    for ratio, least in ((0.1, 5), (0.3, 2), (0.0, 1)):
        got = drop_boilerplate(frame(rows, PAGES), "host", most_ratio=ratio, least_pages=least).collect()
        assert sorted(map(str, ((r["doc_id"], r["text"], r["host"]) for r in got))) == sorted(map(str, brute(rows, ratio, least)))


def test_ratio_is_of_the_host(frame):
    rows = [(i, "x", "a") for i in range(10)] + [(i + 10, "x" if i < 6 else "y", "b") for i in range(100)]
    digest = {hashlib.md5(x.encode()).digest(): x for x in "xy"}
    found = {(r["host"], digest[bytes(r["line"])]): (r["n_pages"], r["host_pages"]) for r in boilerplate(frame(rows, PAGES), "host").collect()}
    assert found == {("a", "x"): (10, 10), ("b", "y"): (94, 100)}


def test_beyond_the_broadcast_the_rows_are_the_same(frame, monkeypatch):
    rows = [(i, f"x\n{i}", "ab"[i % 2]) for i in range(40)] + [(50, "x", None)]
    docs = frame(rows, PAGES)
    first = sorted(map(str, drop_boilerplate(docs, "host").collect()))
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    assert sorted(map(str, drop_boilerplate(docs, "host").collect())) == first


def test_clashing_columns_and_no_rows(frame):
    docs = frame([(i, "x\ny", "a", 9, "z") for i in range(6)], PAGES + ", n_dropped int, line string")
    got = drop_boilerplate(docs, "host")
    assert got.columns == ["doc_id", "text", "host", "line", "n_dropped"]
    assert {tuple(r)[1:] for r in got.collect()} == {("", "a", "z", 2)}
    assert drop_boilerplate(frame([], PAGES), "host").collect() == []


def test_query_equals_its_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = QUERIES["op6_line_dedup"](spark, sf_dir)
    expected = connection.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op6_line_dedup']})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows) == sorted(expected) and sum(r[3] for r in rows) > 0
