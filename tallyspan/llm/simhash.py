"""SimHash near-dedup by multi-index hashing.

A text's fingerprint has, bit by bit, the majority among the hashes of its word
shingles. Texts with equal fingerprints are one node. To find nodes within a distance,
fingerprints are cut into segments, and each segment's value is a key of that segment's
table. If two fingerprints differ in at most ``radius`` bits, the pigeonhole principle
says in how few bits some segment of theirs differs; the small Hamming ball of that
radius around a segment's value is enumerated, the table's matches are fetched by an
equi-join, and the complete distance of each is verified.

Each pair is looked up from one of its ends only, so half of a ball will do: the values
that set at least as many bits as they clear.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.blocks import blocks
from tallyspan.llm.components import components, joined
from tallyspan.llm.tables import cut, extended, few
from tallyspan.llm.words import BY_SPACE_LOWER, Hasher, encode, mix, spans

SEED = 42
_CHUNK = 1 << 15
_HASHER = Hasher(31)
_BLOCK_BYTES = 1_000_000
# Fingerprints of pairs at the similarity asked for differ by more bits than the mean and so
# many deviations in 3 of 10 million pairs; texts of fewer shingles are not judged by them.
_DEVIATIONS, _FEW_SHINGLES = 5.0, 64
# Tables of keys meet tables as narrow as they are: to move both costs less than a copy of a
# long one in the driver and in each executor.
_FEW_KEYS = 200_000
_SLACK = 1e-6  # of products with a similarity, whose rounding must lose no pair


def fingerprint(tokens: list[bytes], words: int) -> list[int]:
    """A signed 64-bit number: majority bits of the hashes (XXH64, seed 42) of all shingles.

    Shingles are ``words`` words joined by one space and count as often as they occur; fewer
    words are one shingle, and none have all bits zero.
    """
    if not tokens:
        return [0]
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter(
        (digest(joined[s:e], SEED)
         for s, e in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64), 1)


def majority(hashes: np.ndarray, lanes: int) -> list[int]:
    """``lanes`` signed 64-bit numbers: a bit is 1 if set in over half of the ``hashes``.

    The first lane is made of the hashes, further ones of numbers mixed from them.
    """
    counts = np.zeros((lanes, 64), np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK]
        for lane in range(lanes):
            own = (part if lane == 0 else mix(part + np.uint64(lane))).astype(">u8")
            bits = np.unpackbits(own.view(np.uint8)).reshape(-1, 64)
            counts[lane] += bits.sum(axis=0, dtype=np.uint32)
    set_bits = np.packbits(counts * 2 > len(hashes), axis=1)
    return [int.from_bytes(lane.tobytes(), "big", signed=True) for lane in set_bits]


def band_keys(shingles: np.ndarray, bands: int, least: int) -> np.ndarray:
    """A signed 64-bit key for each band: of ``least`` least hashes of the set of shingles.

    Each least hash is taken by a hash function of its own, so two texts agree in it with
    the probability of their Jaccard similarity, however few their shingles.
    """
    low = np.full(bands * least, ~np.uint64(0))
    salts = mix(np.arange(1, bands * least + 1, dtype=np.uint64))
    for i in range(0, len(shingles), 256):  # small enough to stay in a core's cache
        low = np.minimum(low, mix(shingles[i:i + 256] ^ salts[:, None]).min(axis=1))
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for column in low.reshape(bands, least).T:
        keys = mix(keys ^ column) + np.uint64(1)
    return keys.view(np.int64)


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with ``fp`` (an array of one bigint) for its ``text``, which is left out."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(encode(text.as_py(), BY_SPACE_LOWER).split(), words)
                     for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(found, pa.list_(pa.int64()))], [*others, "fp"])

    return docs.mapInArrow(run, extended(docs, "fp array<bigint>", without=("text",)))


def segments_for(n: int, bits: int = 64) -> int:
    """How many segments: so that a segment's values are about as many as fingerprints.

    Any number gives the same pairs; this one keeps the tables' buckets short as the
    data grow, and the balls small while they do not.
    """
    return max(2, min(8, round(bits / max(8.0, math.log2(max(n, 2)) + 2))))


def layout(bits: int, segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment; none crosses a 64-bit lane."""
    lanes = bits // 64
    out = []
    for lane in range(lanes):
        own = segments // lanes + (lane < segments % lanes)
        at = 0
        for i in range(own):
            width = 64 // own + (i < 64 % own)
            out.append((64 * lane + at, width))
            at += width
    return out


def radii(radius: int, segments: int) -> list[int]:
    """The ball's radius in each segment that finds every pair within ``radius`` bits.

    If the first a + 1 segments all differ in more than s bits and the others in more
    than s - 1, the whole differs in more than s * segments + a = radius.
    """
    s, a = divmod(radius, segments)
    return [s if i <= a else s - 1 for i in range(segments)]


def _ball(value: Column, width: int, radius: int, half: bool) -> Column:
    """Array of (key, even): the values within ``radius`` bits of ``value``.

    ``half``: only those that set at least as many bits as they clear. Of two values the
    one with fewer set bits then meets the other; if both have as many (``even``), each
    meets the other.
    """
    masks = [sum(1 << b for b in x)
             for d in range(radius + 1) for x in itertools.combinations(range(width), d)]
    flips = F.array(*[F.lit(m).cast("bigint") for m in masks])
    rise = lambda m: F.bit_count(m.bitwiseAND(F.bitwise_not(value))) * 2
    if half:
        flips = F.filter(flips, lambda m: rise(m) >= F.bit_count(m))
    return F.transform(flips, lambda m: F.struct(
        value.bitwiseXOR(m).alias("key"), (rise(m) == F.bit_count(m)).alias("even")))


def _segment(fp: Column, low: int, width: int) -> Column:
    lane, at = divmod(low, 64)
    return F.shiftrightunsigned(fp[lane], at).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def distance(a: Column, b: Column, lanes: int) -> Column:
    """Number of differing bits of two fingerprints."""
    out = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, lanes):
        out = out + F.bit_count(a[i].bitwiseXOR(b[i]))
    return out


def matches(
    probes: DataFrame, nodes: DataFrame, parts: list[tuple[int, int]], balls: list[int],
    most: int, lanes: int, half: bool,
) -> DataFrame:
    """(a, b, bits): probes (node, fp) and nodes (node, fp) within ``most`` bits, a <> b.

    ``half``: the probes are the nodes, and each pair is looked up from one end; a pair may
    come more than once, from several segments. Otherwise each probe looks for the nodes
    before it, and a pair comes from the first segment that shows it.
    """
    keys = [i for i, r in enumerate(balls) if r >= 0]
    table = nodes.select(
        F.col("node").alias("b"), F.col("fp").alias("fp_b"),
        F.posexplode(F.array(*[_segment(F.col("fp"), *parts[i]) for i in keys])).alias("part", "key"))
    def lookup(part: int, low: int, width: int, ball: int) -> Column:
        return F.transform(
            _ball(_segment(F.col("fp"), low, width), width, ball, half),
            lambda v: F.struct(F.lit(part).alias("part"), v["key"].alias("key"), v["even"].alias("even")))

    lookups = [lookup(k, *parts[i], balls[i]) for k, i in enumerate(keys)]
    probe = probes.select(
        F.col("node").alias("a"), F.col("fp").alias("fp_a"),
        F.explode(F.concat(*lookups)).alias("x")).select("a", "fp_a", "x.part", "x.key", "x.even")
    bits = distance(F.col("fp_a"), F.col("fp_b"), lanes)
    once = (~F.col("even") & (F.col("a") != F.col("b"))) | (F.col("b") < F.col("a"))
    if not half:
        once = F.col("b") < F.col("a")
        for k, i in enumerate(keys):
            apart = F.bit_count(_segment(F.col("fp_a"), *parts[i]).bitwiseXOR(_segment(F.col("fp_b"), *parts[i])))
            once = once & ((probe["part"] <= k) | (apart > balls[i]))
    on = [probe["part"] == table["part"], probe["key"] == table["key"], bits <= most, once]
    return probe.join(table, on).select("a", "b", bits.alias("bits"))


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, segments: int | None = None,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text).

    A-Z are lower-cased and words are split at ASCII white space. ``fingerprint`` is 16
    hex digits; documents whose fingerprints differ in ``radius`` bits or fewer are
    linked, all of them, and ``component_id`` is the least doc_id that links reach.
    Equal fingerprints are one node, so copies cost a sum made in the map tasks.

    Null and empty texts have fingerprint zero and are linked like any other; repeated
    rows have equal fingerprints; a null doc_id is a document too, and its component_id
    is null only where nothing else is reached; other columns are ignored; no rows give
    no rows.
    """
    prints = cut(fingerprints(docs.select("doc_id", "text"), words).select(
        "doc_id", F.col("fp")[0].alias("node"), "fp"))
    nodes = cut(prints.groupBy("node", "fp").agg(F.min("doc_id").alias("first")))
    if segments is None:
        segments = segments_for(nodes.count())
    pairs = matches(nodes, nodes, layout(64, segments), radii(radius, segments), radius, 1, half=True)
    reached = components(pairs.select("a", "b")).toDF("node", "component")
    ids = nodes.join(reached, "node", "left").select(
        "node", "first", F.coalesce("component", "node").alias("component"))
    least = ids.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = ids.join(least, "component").select("node", "component_id")
    return prints.join(ids, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def _shingles(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each of a block of texts, as ascending 64-bit hashes."""
    data = b" ".join(texts)
    starts, ends = spans(data)
    hashes = _HASHER.words(data, starts, ends) if len(starts) else np.empty(0, np.uint64)
    cuts = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
    for first, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = hashes[first:end]
        yield np.unique(_HASHER.runs(own, min(words, len(own)))) if len(own) else own


def _profiles(docs: DataFrame, words: int, lanes: int, bands: int, least: int) -> DataFrame:
    """What is known of each text, in one pass over ``docs`` (__row, text).

    same: a digest of the words, equal for texts of equal words; n: distinct shingles;
    wide: SimHash fingerprint of ``lanes`` bigints; keys: a bigint for each band.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", _BLOCK_BYTES):
                texts = [encode(t.as_py(), BY_SPACE_LOWER) for t in part.column("text")]
                same = [xxhash.xxh3_128_digest(b" ".join(t.split())) for t in texts]
                sizes, wide, keys = [], [], []
                for own in _shingles(texts, words):
                    sizes.append(len(own))
                    wide.append(majority(own, lanes) if len(own) else [0] * lanes)
                    keys.append(band_keys(own, bands, least) if len(own) else np.zeros(bands, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("__row"), pa.array(same, pa.binary()), pa.array(sizes, pa.int32()),
                     pa.array(wide, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
                    ["__row", "same", "n", "wide", "keys"])

    return docs.select("__row", "text").mapInArrow(
        run, "__row bigint, same binary, n int, wide array<bigint>, keys array<bigint>")


def _ends(pairs: DataFrame) -> DataFrame:
    """(__row): the rows in ``pairs`` (a, b), once each."""
    return pairs.select(F.explode(F.array("a", "b")).alias("__row")).distinct()


def _sets_of(needed: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(__row, shingles) of the rows ``needed`` (__row): distinct shingles as 32-bit hashes."""
    needed = cut(needed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", _BLOCK_BYTES):
                sets = [(own >> np.uint64(32)).astype(np.uint32).view(np.int32) for own in _shingles(
                    [encode(t.as_py(), BY_SPACE_LOWER) for t in part.column("text")], words)]
                offsets = pa.array(np.cumsum([0] + [len(own) for own in sets]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("__row"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets), pa.int32()))],
                    ["__row", "shingles"])

    return cut(docs.select("__row", "text").join(few(needed), "__row", "left_semi").mapInArrow(
        run, "__row bigint, shingles array<int>"))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b), a table, of rows whose sets of shingles overlap by ``similarity``.

    Only the sets of these rows are moved, however many others there are.
    """
    sets = sets.join(few(cut(_ends(pairs))), "__row", "left_semi")
    both = pairs.select("a", "b").join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return both.where((union > 0) & (shared >= similarity * union)).select("a", "b")


def _may_be_alike(similarity: float, words_bits: int) -> Column:
    """What two similar rows (na, wa), (nb, wb) always, or all but always, have.

    Sets whose sizes are further apart cannot be so similar. The fingerprints of long texts
    then differ in bits whose number is spread around its mean; beyond ``_DEVIATIONS`` of
    it no pair is expected. Short texts have too few shingles for that, and skip it.
    """
    sizes = F.least("na", "nb") >= similarity * F.greatest("na", "nb")
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    most = words_bits * share + _DEVIATIONS * math.sqrt(words_bits * share * (1 - share))
    apart = distance(F.col("wa"), F.col("wb"), words_bits // 64)
    return sizes & ((F.least("na", "nb") < _FEW_SHINGLES) | (apart <= math.ceil(most)))


def _accepted(left: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of ``left`` (a, b, bits).

    Each a meets its nearest candidate, and in further rounds the next, as long as a round
    links a good part of the rows that meet one.
    """
    nearest = F.min_by("b", F.struct("bits", "b")).alias("b")
    links = left.select("a", "b").where("false")
    while True:
        tried = cut(left.groupBy("a").agg(nearest))
        good = cut(_verified(tried, sets, similarity))
        links = links.union(good)
        if good.count() * 10 <= tried.count():
            return cut(links)
        left = cut(left.join(good.select("a"), "a", "left_anti").join(tried, ["a", "b"], "left_anti"))


def _placed(table: DataFrame, reached: DataFrame) -> DataFrame:
    """``table`` (node) with ``component``, of ``reached`` (node, component) or the node itself."""
    return table.join(few(reached, _FEW_KEYS), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _mixed(table: DataFrame, reached: DataFrame) -> DataFrame:
    """(node, key, component): the rows of ``table`` (node, key) whose key holds several components.

    ``reached``: (node, component); a node without a link is its own component.
    """
    placed = _placed(table, reached)
    mixed = cut(placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key"))
    return cut(placed.join(few(mixed, _FEW_KEYS), "key", "left_semi"))


def _rare(sets: DataFrame, similarity: float) -> DataFrame:
    """(node, key, at, n): the rarest shingles of each of ``sets`` (__row, shingles), as keys.

    In order of how many of the sets hold a shingle, rarest first, two sets so similar have
    a shingle in common among the first ``n - similarity * n + 1`` of each, whatever they
    are: the others are too few. ``at`` is the shingle's place. Shingles that no other set
    holds come first and are left out, so a set with many of them has few keys or none.
    """
    each = sets.select(F.col("__row").alias("node"), F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    common = cut(each.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1"))
    ranked = each.join(few(common, _FEW_KEYS), "key").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("held", "key"))).alias("common"))
    ranked = ranked.withColumn("own", F.col("n") - F.size("common"))
    most = F.col("n") - F.ceil(similarity * F.col("n") - _SLACK).cast("int") + 1 - F.col("own")
    return cut(ranked.withColumn("most", most).where("most > 0").select(
        "node", "n", "own", F.posexplode(F.slice("common", 1, F.col("most"))).alias("i", "x")).select(
        "node", F.col("x.key").alias("key"), (F.col("own") + F.col("i")).alias("at"), "n"))


def _may_share(similarity: float) -> Column:
    """What two similar sets (na, nb) have, which meet at places (ata, atb) of a shingle of both.

    It holds at the first such shingle: what they share is not before it.
    """
    sizes = F.least("na", "nb") >= similarity * F.greatest("na", "nb") - _SLACK
    shared = similarity / (1 + similarity) * (F.col("na") + F.col("nb"))
    return sizes & (F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")) >= shared - _SLACK)


def _beside(rows: DataFrame, similarity: float, turn: int, salts: int) -> DataFrame:
    """(a, b), b < a: rows (node, key, at, n, component) and two others of a key, if in another component.

    One is the key's first by place, whose rarer shingles are the fewest: of a group of near
    copies it is like the most others. The other is the one before in a random order. Rows
    are dealt out before the order is made, so that it is not moved with them.
    """
    salt = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(salts))
    rows, part = rows.withColumn("salt", salt).repartition("key", "salt"), Window.partitionBy("key", "salt")
    random = part.orderBy(F.xxhash64("component", F.lit(turn)), F.xxhash64("node", F.lit(turn)))
    row = F.struct("node", "component", "n", "at")
    met = rows.select("node", "component", F.col("n").alias("na"), F.col("at").alias("ata"), F.array(
        F.first(row).over(part.orderBy("at", "node")), F.lag(row).over(random)).alias("others"))
    met = met.select("node", "component", "na", "ata", F.explode("others").alias("x")).select(
        "*", F.col("x.n").alias("nb"), F.col("x.at").alias("atb"))
    return met.where((F.col("component") != F.col("x.component")) & _may_share(similarity)).select(
        F.greatest("node", "x.node").alias("a"), F.least("node", "x.node").alias("b")).distinct()


def _across(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b), b < a: all pairs of ``rows`` (node, key, at, n, component) of one key that may be similar.

    Within a key, the rows outside its largest component meet all those of others, so a key
    that one component holds makes no pair.
    """
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"))
    outside = rows.join(largest, "key").where("component <> largest")
    side = lambda df, c, x: df.select(
        "key", F.col("node").alias(x), F.col("component").alias(f"c{c}"), F.col("n").alias(f"n{c}"),
        F.col("at").alias(f"at{c}")).alias(c)
    pairs = side(outside, "a", "x").join(
        side(rows, "b", "y"),
        (F.col("a.key") == F.col("b.key")) & (F.col("ca") != F.col("cb")) & _may_share(similarity))
    return pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def similar_groups(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, wide: int = 8, bands: int = 28,
    least: int = 5, bucket_rows: int = 200_000,
) -> DataFrame:
    """(__row, group) for each row of ``docs`` (__row, text), a table; group is a row number.

    Rows are linked if the Jaccard similarity of their sets of ``words``-word shingles is
    at least ``similarity``, and a group is what links reach: no two candidates so similar
    are in different groups, whatever the order of rows. Its number is its first row's.

    Candidates share one of ``bands`` keys, each of ``least`` least hashes: of pairs at a
    similarity of s, all but (1 - s ** least) ** bands, which is 1.5e-5 at 0.8. A pair that
    may be similar by its numbers of shingles and by SimHash fingerprints of ``wide`` lanes
    has its sets compared.

    Texts of equal words are one node throughout. A large group of near copies is not
    compared pair by pair: a first pass looks, for each key, at the first row and at the
    one before (hot keys in parts of about ``bucket_rows``), which is a bounded number of
    candidates for a row. The rows of keys that then hold several components get further
    keys, their rarest shingles, of which any two so similar share one at places that allow
    it. In passes each row meets, in every such key, two others, if still in another
    component, until few passes' pairs are links. Then every pair of one such key that is
    still in two components is compared if the places of the shingle allow it. Keys of one
    component are left out after passes with many links, and before that last comparison.

    Null texts and texts without words are one group; other columns are ignored; no
    rows give no rows.
    """
    prints = cut(_profiles(docs, words, wide, bands, least), "zstd")
    nodes = cut(prints.groupBy("same").agg(
        F.min("__row").alias("node"), F.first("n").alias("n"), F.first("wide").alias("wide"),
        F.first("keys").alias("keys")))
    salts, known = 1 + nodes.count() // bucket_rows, nodes.select("node", "n", "wide")
    similar = _may_be_alike(similarity, 64 * wide)

    def measured(pairs: DataFrame) -> DataFrame:
        return cut(pairs.distinct().join(known.toDF("a", "na", "wa"), "a").join(
            known.toDF("b", "nb", "wb"), "b").where(similar).select(
            "a", "b", distance(F.col("wa"), F.col("wb"), wide).alias("bits")))

    table = nodes.select("node", F.explode("keys").alias("key"))
    shared = cut(table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    table = cut(table.join(few(shared, _FEW_KEYS), "key", "left_semi"))
    bucket = Window.partitionBy("key", F.pmod(F.xxhash64("node"), F.lit(salts))).orderBy("node")
    looked = table.select(
        "node", F.lag("node").over(bucket).alias("before"), F.first("node").over(bucket).alias("first"))
    near = measured(looked.select(
        F.col("node").alias("a"), F.explode(F.array("before", "first")).alias("b")).where("b < a"))
    links = _accepted(near, _sets_of(_ends(near), docs, words), similarity)
    reached = cut(components(links))
    open_rows = _mixed(table, reached)
    sets = _sets_of(open_rows.select(F.col("node").alias("__row")).distinct(), docs, words)
    n_open, rows, turn = sets.count(), _mixed(_rare(sets, similarity), reached).drop("component"), 0
    while True:
        turn += 1
        tried = cut(_beside(_placed(rows, reached), similarity, turn, salts))
        good = cut(_verified(tried, sets, similarity))
        n_good = good.count()
        if n_good:
            reached = joined(reached, good)
        if n_good * 10 > n_open:  # keys of one component stay so
            rows = _mixed(rows, reached).drop("component")
        if n_good * 10 <= tried.count():
            break
    last = cut(_verified(cut(_across(_mixed(rows, reached), similarity)), sets, similarity))
    if not last.isEmpty():
        reached = joined(reached, last)
    reached = reached.toDF("node", "group")
    groups = nodes.join(reached, "node", "left").select(
        "same", F.coalesce("group", "node").alias("group"))
    return prints.select("__row", "same").join(groups, "same").select("__row", "group")
