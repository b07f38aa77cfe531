"""The Merkle manifest against plain trees, and its SQL."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import merkle, queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def grown(nodes):
    """Levels of a tree, from its leaves up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i % 2, level[i ^ 1] if i ^ 1 < len(level) else None))
        i //= 2
    return out


def fold(leaf, steps):
    for right, other in steps:
        leaf = h(leaf if other is None else other + leaf if right else leaf + other)
    return leaf


def plain(rows):
    """Rows of the query, by doc_id, for rows (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n_chars):
        return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}"
                         for x in (doc_id, source, lang, n_chars, text)))

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    names = sorted(trees, key=lambda x: b"" if x is None else b"=" + x.encode())
    own = {}
    for name in names:
        trees[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        own[name] = grown([leaf(*r) for r in trees[name]])
    top = grown([own[n][-1][0] for n in names])
    out = []
    for j, name in enumerate(names):
        for i, row in enumerate(trees[name]):
            steps = proof(own[name], i) + proof(top, j)
            doc_id, text, lang, source, n = row
            bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n is not None
            folded = fold(leaf(doc_id, text, lang, source, n + 1) if bad else leaf(*row), steps)
            out.append((doc_id, leaf(*row), own[name][-1][0], top[-1][0],
                        h("".join(s for _, s in steps if s)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def rows_of(n, seed=1):
    draw = random.Random(seed)
    return [(i, draw.choice(["", "tëxt", None, "a\nb"]) if i % 3 else f"text {i}",
             draw.choice(["en", "en", "en", "fr", "é", None, ""]), draw.choice(["s", None]),
             draw.choice([None, i, 7])) for i in draw.sample(range(10 * n), n)]


ODD = [(None, None, None, None, None), (None, None, None, None, None), (5, "x", "zz", "s", 1), (5, "x", "zz", "s", 1),
       (5, "y", "zz", "s", 1), (6, "long " * 50_000, "zz", "s", 2**63 - 1), (11, "t", "zz", "s", 2**62)]


@pytest.mark.parametrize("rows", [rows_of(500), ODD, rows_of(1), rows_of(3) + ODD], ids=["many", "odd", "one", "few"])
def test_query_equals_plain_trees(spark, sf_folder, rows):
    assert got(queries.op13_manifest(spark, sf_folder({"documents": (rows, DOCS)}))) == plain(rows)


def test_empty_table(spark, sf_folder):
    assert got(queries.op13_manifest(spark, sf_folder({"documents": ([], DOCS)}))) == []


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_blocks_of_any_size_give_the_same_tree(frame, levels):
    leaves = [(i, "a" if i < 70 else f"t{i % 3}", h(str(i)), 3) for i in range(90)]
    found = merkle.manifest(frame(leaves, "id bigint, name string, leaf string, size int", 5), "name", ["id"], levels)
    rows = {r.id: r for r in found.withColumn("again", merkle.folded(
        F.col("leaf"), F.col("sides"), F.col("siblings"))).collect()}
    assert len(rows) == 90 and all(r.again == r.root and r.size == 3 for r in rows.values())
    own = {n: grown([x for _, m, x, _ in leaves if m == n]) for n in ("a", "t0", "t1", "t2")}
    assert all(r.subroot == own[r.name][-1][0] for r in rows.values())
    steps = proof(own["a"], 69)
    assert rows[69].siblings.startswith("".join(s for _, s in steps if s))
    assert rows[69].sides.startswith("".join("N" if s is None else "RL"[right] for right, s in steps))


@pytest.mark.parametrize("n", range(1, 18))
def test_witnesses_are_extended_as_nodes_are_appended(n):
    found = merkle.Witnesses()
    nodes = [h(str(i)) for i in range(n)]
    for node in nodes:
        found.append(node)
    levels = grown(nodes)
    assert found.close(None) == levels[-1][0]
    for i in range(n):
        steps = proof(levels, i)
        assert "".join(found.siblings[i]) == "".join(s for _, s in steps if s)
        assert "".join(found.sides[i]) == "".join("N" if s is None else "RL"[r] for r, s in steps)


def test_numbers_do_not_depend_on_the_number_of_tasks(spark, frame):
    rows = frame([(i % 7, f"k{i % 3}", i) for i in range(300)], "a int, tree string, b int", 6)
    expected = None
    for tasks in ("3", "17"):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", tasks)
        try:
            found = sorted((r.tree, r.number, r.a, r.b) for r in merkle.numbered(rows, "tree", ["a", "b"]).collect())
        finally:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        expected = expected or found
        assert found == expected
    assert [x[1] for x in expected] == [*range(100)] * 3
    assert all([x[2:] for x in expected if x[0] == k] == sorted(x[2:] for x in expected if x[0] == k)
               for k in ("k0", "k1", "k2"))
