"""SimHash near-dedup against brute force, and its edge cases."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspan.llm import components as stars
from tallyspan.llm import simhash
from tallyspan.llm.components import components
from tallyspan.llm.tables import with_row

DOCS = "doc_id bigint, text string"


def brute_print(text, words):
    tokens = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if not tokens:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(tokens[i:i + words]), 42)
              for i in range(max(1, len(tokens) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(n, linked):
    group = list(range(n))
    while True:
        old = list(group)
        for a, b in linked:
            group[a] = group[b] = min(group[a], group[b])
        if old == group:
            return group


@pytest.mark.parametrize("segments", [2, 3, 4, 5, 8])
@pytest.mark.parametrize("half", [True, False])
def test_matches_are_all_pairs_within_the_radius(spark, segments, half):
    draw = random.Random(segments)
    values = set()
    for _ in range(40):
        x = draw.getrandbits(64)
        values.add(x)
        for _ in range(4):
            y = x
            for b in draw.sample(range(64), draw.randrange(1, 7)):
                y ^= 1 << b
            values.add(y)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame([(v, [v]) for v in values], "node bigint, fp array<bigint>")
    most = 4 if segments > 2 else 3
    found = simhash.matches(nodes, nodes, simhash.layout(64, segments), simhash.radii(most, segments),
                            most, 1, half).collect()
    got = {tuple(sorted((r["a"], r["b"]))) for r in found}
    assert got == {(a, b) for i, a in enumerate(values) for b in values[i + 1:]
                   if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= most}


def test_layout_covers_every_bit_once():
    for bits in (64, 128):
        for segments in range(bits // 64, 12):
            places = [b for low, width in simhash.layout(bits, segments) for b in range(low, low + width)]
            assert sorted(places) == list(range(bits))


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 200)]
    links += [(400, 401), (401, 402), (402, 400), (500, 500), (None, 1), (7, None), (400, 401)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 300)} | {i: 400 for i in (400, 401, 402)}
    assert components(frame.where("a < 0")).collect() == []


def written(monkeypatch, module):
    """What ``module`` cuts from now on."""
    tables, cut = [], module.cut

    def counted(*args):
        tables.append(args)
        return cut(*args)

    monkeypatch.setattr(module, "cut", counted)
    return tables


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    tables = written(monkeypatch, stars)
    links = [(10, 3), (3, 11), (20, 21), (21, 20), (30, 30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {3: 3, 10: 3, 11: 3, 20: 20, 21: 20}
    assert len(tables) == 1
    chain = spark.createDataFrame([(1, 2), (2, 3)], "a bigint, b bigint")
    assert {r["component"] for r in components(chain).collect()} == {1}
    assert len(tables) == 3


def test_more_links_join_the_components_that_are_known(spark):
    draw = random.Random(5)
    for n in (0, 10, 60):
        first = [(draw.randrange(200), draw.randrange(200)) for _ in range(60)]
        more = [(draw.randrange(260), draw.randrange(260)) for _ in range(n)]
        frame = lambda links: spark.createDataFrame(links, "a bigint, b bigint")
        got = stars.joined(components(frame(first)).localCheckpoint(), frame(more)).collect()
        linked = {r["node"]: r["component"] for r in components(frame(first + more)).collect()}
        assert {r["node"]: r["component"] for r in got} == linked
        assert len(got) == len(linked)


def test_groups_are_found_in_few_jobs(frame, monkeypatch):
    texts = [f"{' '.join(f'w{i}x{j}' for j in range(60))} {end}" for i in range(30) for end in ("a", "b", "c")]
    docs = with_row(frame(list(enumerate(texts)), DOCS))
    tables = written(monkeypatch, stars)
    assert simhash.similar_groups(docs).select("group").distinct().count() == 30
    assert len(tables) <= 4


def texts_with_copies():
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(4))
    texts = []
    for _ in range(25):
        words = [word() for _ in range(draw.randrange(1, 400))]
        texts.append(" ".join(words))
        for _ in range(draw.randrange(4)):
            near = list(words)
            for _ in range(draw.randrange(3)):
                near[draw.randrange(len(near))] = word()
            texts.append((" " if draw.random() < 0.5 else "\n").join(near).upper())
    return [*texts, None, "", " \t", "one", "ONE", "Été à", "x" * 4000]


def test_near_duplicates_against_brute_force(frame):
    texts = texts_with_copies()
    prints = [brute_print(t, 4) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    groups = brute_groups(len(texts), links)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in simhash.near_duplicates(frame(list(enumerate(texts)), DOCS)).collect()}
    assert got == {i: (f"{p:016x}", groups[i]) for i, p in enumerate(prints)}


def test_null_ids_repeated_rows_and_no_rows(frame):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 2), (5, "a b c d e", 3), (None, "zz yy xx", 4)]
    got = simhash.near_duplicates(frame(rows, DOCS + ", component_id int")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [
        ("5", "5"), ("None", "5"), ("None", "5"), ("None", "None")]
    assert simhash.near_duplicates(frame([], DOCS)).collect() == []


def shingles(text, words=5):
    tokens = (text or "").lower().split()
    return {tuple(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))} if tokens else set()


def test_similar_groups_keep_no_pair_of_high_similarity_and_join_nothing_else(frame):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    texts = []
    for _ in range(20):
        words = [word() for _ in range(300)]
        texts.append(" ".join(words))
        for edits in (1, 2, 4, 40):
            near = list(words)
            for at in draw.sample(range(300), edits):
                near[at] = word()
            texts.append(" ".join(near))
    texts += [texts[0]] * 30 + [None, "", " ", "tiny text", "tiny text", "tiny"]
    docs = with_row(frame(list(enumerate(texts)), DOCS))
    ids = {r["__row"]: r["doc_id"] for r in docs.collect()}
    got = {ids[r["__row"]]: ids[r["group"]] for r in simhash.similar_groups(docs).collect()}
    assert set(got) == set(range(len(texts)))
    sets = [shingles(t) for t in texts]
    alike = lambda a, b: sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    members = {}
    for i, g in got.items():
        members.setdefault(g, []).append(i)
    for group in members.values():  # every member is like another one
        assert all(any(alike(a, b) for b in group if b != a) for a in group if len(group) > 1)
    kept = sorted(members)
    missed = [(a, b) for i, a in enumerate(kept) for b in kept[i + 1:] if alike(a, b)]
    assert not missed
    assert simhash.similar_groups(with_row(frame([], DOCS))).collect() == []


def test_a_large_group_of_near_copies_is_not_compared_pair_by_pair(frame):
    draw = random.Random(3)
    words = [f"w{draw.randrange(10 ** 6)}" for _ in range(400)]
    texts = []
    for _ in range(300):
        near = list(words)
        near[draw.randrange(400)] = f"v{draw.randrange(10 ** 6)}"
        texts.append(" ".join(near))
    docs = with_row(frame(list(enumerate(texts)), DOCS))
    groups = simhash.similar_groups(docs)
    assert groups.select("group").distinct().count() == 1
    assert groups.where(F.col("group") > F.col("__row")).count() == 0


def grouped(frame, texts):
    docs = with_row(frame(list(enumerate(texts)), DOCS))
    ids = {r["__row"]: r["doc_id"] for r in docs.collect()}
    return {ids[r["__row"]]: ids[r["group"]] for r in simhash.similar_groups(docs).collect()}


def test_a_repeated_line_neither_joins_different_texts_nor_parts_alike_ones(frame):
    draw = random.Random(5)
    prose = lambda n=200: " ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    line = prose(9)
    texts = [f"{prose()}\n" + f"{line}\n" * n for n in (30, 60, 100, 100)]
    same = prose()
    texts += [f"{same}\n" + f"{line}\n" * n for n in (2, 30)]
    got = grouped(frame, texts)
    assert len({got[i] for i in range(4)}) == 4 and got[4] == got[5]
    assert not {got[i] for i in range(4)} & {got[4]}


def test_no_pair_at_the_edge_is_lost(frame):
    draw = random.Random(21)
    texts, pairs = [], []
    for _ in range(150):  # the second text has a run of other words at its end: 0.80 to 0.82
        words = [f"w{draw.randrange(10 ** 9)}" for _ in range(204)]
        other = words[:-draw.randrange(20, 23)]
        other += [f"v{draw.randrange(10 ** 9)}" for _ in range(204 - len(other))]
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(words), " ".join(other)]
    few = [f"x{i}" for i in range(9)]
    pairs.append((len(texts), len(texts) + 1))
    texts += [" ".join(few), " ".join(few[:-1])]  # five shingles against four
    sets = [shingles(t) for t in texts]
    assert all(0.8 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 0.83 for a, b in pairs)
    got = grouped(frame, texts)
    assert [(a, b) for a, b in pairs if got[a] != got[b]] == []
    assert len(set(got.values())) == len(pairs)


def test_groups_do_not_depend_on_the_order_of_rows(frame):
    draw = random.Random(31)
    texts, copies = [], []
    for _ in range(10):  # two copies are each like the original, but not like each other
        words = [f"w{draw.randrange(10 ** 9)}" for _ in range(204)]
        copies.append([[f"v{draw.randrange(10 ** 9)}" for _ in range(18)] + words[18:], words,
                       words[:-18] + [f"v{draw.randrange(10 ** 9)}" for _ in range(18)]])
    for order in ((0, 2, 1), (1, 0, 2), (0, 1, 2)):
        texts = [" ".join(c[i]) for i in order for c in copies]
        sets = [shingles(t) for t in texts]
        alike = [(a, b) for a in range(30) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
        assert len(alike) == 20
        got = grouped(lambda rows, schema: frame(rows, schema, files=1), texts)
        assert [(a, b) for a, b in alike if got[a] != got[b]] == []
        assert len(set(got.values())) == 10


def test_texts_of_one_template_that_are_not_alike_are_not_compared_pair_by_pair(frame, monkeypatch):
    draw = random.Random(41)
    word = lambda: f"w{draw.randrange(10 ** 9)}"
    head = [word() for _ in range(40)]
    texts = [" ".join(head + [word() for _ in range(9)]) for _ in range(200)]  # at 0.67, in most keys
    pairs = [(i, 200 + i) for i in range(20)]
    texts += [texts[i].rsplit(" ", 1)[0] + " other" + str(i) for i, _ in pairs]
    compared, verified = [], simhash._verified

    def counted(pairs, sets, similarity):
        compared.append(pairs.count())
        return verified(pairs, sets, similarity)

    monkeypatch.setattr(simhash, "_verified", counted)
    got = grouped(frame, texts)
    assert [(a, b) for a, b in pairs if got[a] != got[b]] == []
    assert len(set(got.values())) == 200
    assert sum(compared) < 10 * len(texts)


def test_only_the_sets_of_pairs_are_moved(frame):
    sets = frame([(i, [i // 2, 1000, 1001, 1002, 1003]) for i in range(400)], "__row bigint, shingles array<int>")
    pairs = frame([(3, 2), (4, 3), (7, 6)], "a bigint, b bigint")
    got = simhash._verified(pairs, sets, 0.8)
    assert sorted(map(tuple, got.collect())) == [(3, 2), (7, 6)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # both sides


def test_passes_with_few_links_do_not_look_through_all_keys(frame, monkeypatch):
    draw = random.Random(47)
    word = lambda: f"w{draw.randrange(10 ** 9)}"
    texts = [" ".join(word() for _ in range(60)) for _ in range(400)]
    docs = with_row(frame(list(enumerate(texts)), DOCS))
    good = docs.sparkSession.createDataFrame([(1, 0)], "a bigint, b bigint")
    sets = frame([(i, list(range(60))) for i in range(400)], "__row bigint, shingles array<int>")
    passes, looked, links = [], [], iter([good] * 3 + [good.where("false")] * 9)
    mixed = simhash._mixed
    monkeypatch.setattr(simhash, "_sets_of", lambda *args: sets)
    monkeypatch.setattr(simhash, "_accepted", lambda *args: good.where("false"))
    monkeypatch.setattr(simhash, "_verified", lambda *args: next(links))
    monkeypatch.setattr(simhash, "_beside", lambda *args: passes.append(args) or good)
    monkeypatch.setattr(simhash, "_mixed", lambda *args: looked.append(args) or mixed(*args))
    simhash.similar_groups(docs)
    assert len(passes) == 4 and len(looked) == 3  # before, one more for each of the three


def test_rare_shingles_find_every_similar_pair(frame):
    draw = random.Random(43)
    sets = []
    for _ in range(40):
        base = draw.sample(range(400), draw.randrange(1, 50))
        for _ in range(4):
            sets.append(sorted({*draw.sample(base, max(1, len(base) - draw.randrange(5))),
                                *draw.sample(range(400), draw.randrange(3))}))
    rows = frame([(i, s) for i, s in enumerate(sets)], "__row bigint, shingles array<int>")
    rare = simhash._rare(rows, 0.8).withColumn("component", F.col("node"))
    found = {(r["b"], r["a"]) for r in simhash._across(rare, 0.8).collect()}
    alike = {(i, j) for i, a in enumerate(map(set, sets)) for j, b in enumerate(map(set, sets))
             if i < j and len(a & b) >= 0.8 * len(a | b)}
    assert len(alike) > 50 and alike <= found
