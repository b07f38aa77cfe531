"""Nearest neighbours: recall against brute force, exact scores, ties and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import ann
from tallyspan.llm.queries import QUERIES

VECTORS = "vec_id bigint, embedding array<float>"


def rows_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in out.items()}


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        own = list(ids).index(q)
        scores = (x * x[own]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if i != own][:k]
        out[q] = [(n + 1, int(ids[i]), scores[i]) for n, i in enumerate(order)]
    return out


@pytest.mark.parametrize("shape", ["clusters", "uniform", "lengths"])
def test_recall_and_scores(frame, shape):
    draw = np.random.default_rng(3)
    n, d = 3000, 16
    x = draw.normal(size=(n, d))
    if shape == "clusters":
        x = draw.normal(size=(30, d))[draw.integers(0, 30, n)] + 0.3 * x
    if shape == "lengths":
        x *= draw.lognormal(0, 1, n)[:, None]
    x = x.astype(np.float32).astype(float)
    got = rows_of(ann.search(frame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS), F.col("vec_id") % 20 == 0, k=20))
    expected = brute(np.arange(n), x, range(0, n, 20), 20)
    assert set(got) == set(expected)
    found = total = 0
    for q, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, 21))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        for _, i, score in rows:
            assert i != q and score == (x[i] * x[q]).sum()
        found += len({r[1] for r in rows} & {r[1] for r in expected[q]})
        total += 20
    assert found / total >= 0.9


def test_hot_vector_and_ties(frame, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    draw = np.random.default_rng(4)
    x = draw.normal(size=(600, 8)).astype(np.float32)
    x[200:500] = x[0]
    got = rows_of(ann.search(frame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS), F.col("vec_id") % 100 == 0, k=5, recall=1.0))
    expected = brute(np.arange(600), x.astype(float), range(0, 600, 100), 5)
    for q in (0, 200, 300, 400):  # copies of one vector: the smallest ids, but for the query's own
        assert [r[1] for r in got[q]] == [r[1] for r in expected[q]]


def test_equal_vectors_are_one_class(frame, monkeypatch):
    """Few copies are indexed and a class is met once; every asking copy gets its whole answer."""
    indexed, asked = [], []
    met = ann._met

    def counting(held, probes, sizes, k):
        indexed.append(held.count())
        asked.append(probes.select("c1", "c2").distinct().count())
        return met(held, probes, sizes, k)

    monkeypatch.setattr(ann, "_met", counting)
    draw = np.random.default_rng(6)
    x = draw.normal(size=(900, 8)).astype(np.float32)
    x[300:600] = x[0] * 3  # a third of all rows
    x[600:604] = x[1]  # fewer copies than neighbours asked for
    ids = draw.permutation(900)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    got = rows_of(ann.search(frame(rows, VECTORS), F.col("vec_id") % 3 == 0, k=7, recall=1.0))
    expected = brute(ids, x.astype(float), range(0, 900, 3), 7)
    assert indexed == [900 - 300 + 8]
    assert asked == [len({x[n].tobytes() for n in range(900) if ids[n] % 3 == 0})]
    assert set(got) == set(expected)
    hot = {int(i) for i in ids[300:600] if i % 3 == 0} | {int(i) for i in ids[600:604] if i % 3 == 0}
    for q in hot:
        assert [(r[0], r[1]) for r in got[q]] == [(r[0], r[1]) for r in expected[q]]
    hits = sum(len({r[1] for r in got[q]} & {r[1] for r in expected[q]}) for q in got)
    assert hits >= 0.97 * 7 * len(got)


def test_leaves_stay_of_one_size_as_rows_grow(frame):
    """The sample follows the leaves, so that twice the rows make about twice the leaves."""
    draw = np.random.default_rng(7)
    leaves = []
    for n in (2000, 8000):
        x = draw.normal(size=(n, 6))
        share = ann.ROWS_A_LEAF * (n / 50) / n
        sample = x[draw.random(n) < share]
        leaves.append(ann.fit(sample, 10.0, max(ann.ROWS_A_LEAF, int(50 * share))).leaves)
    assert 3 < leaves[1] / leaves[0] < 5.5


def test_unusable_vectors_few_rows_and_no_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0]), (4, None), (40, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [0.5, 0.5]), (60, [nan, nan]), (3, [1.0, 1.0])]
    docs = frame([(*r, 1, "x") for r in rows], VECTORS + ", rank int, score string")
    got = rows_of(ann.search(docs, F.col("vec_id") % 20 == 0, k=20))
    assert set(got) == {0, 20}
    assert [(i, s) for _, i, s in got[0]] == [(3, 1.0), (3, 1.0), (None, 0.5), (20, 0.0)]
    assert ann.search(frame([], VECTORS), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.search(frame([(1, [1.0])], VECTORS), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.search(frame([(20, [1.0])], VECTORS), F.col("vec_id") % 20 == 0).collect() == []


def test_the_tree_visits_every_leaf_once_and_finds_what_it_stored():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(500, 6))
    tree = ann.fit(x, float(np.sqrt((x * x).sum(axis=1).max())), 20)
    assert sorted(tree.visits(x[0])) == list(range(tree.leaves)) and tree.leaves > 10
    leaf = tree.find(tree.stored(x))
    assert set(leaf.tolist()) <= set(range(tree.leaves))
    same = ann.fit(np.ones((100, 3)), 2.0, 10)
    assert same.leaves == 1 and list(same.visits(np.ones(3))) == [0]


def test_query_reaches_its_recall(spark, sf_dir):
    import duckdb
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet' WHERE embedding IS NOT NULL").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    keep = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    ids, x = ids[keep], x[keep]
    got = rows_of(QUERIES["op1_nearest_neighbours"](spark, sf_dir))
    expected = brute(ids, x, [int(i) for i in ids if i % 20 == 0], 20)
    assert set(got) == set(expected)
    hits = [len({r[1] for r in got[q]} & {r[1] for r in expected[q]}) for q in got]
    assert sum(hits) >= 0.9 * 20 * len(hits)
