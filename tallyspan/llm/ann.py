"""Approximate nearest neighbours: a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample; every vector is then led down it to a leaf. A
query walks the tree with a priority queue, nearest branch first, and visits leaves until
it has seen enough. How many is calibrated: for a bounded set of queries the true
neighbours are found by brute force over all rows, and visits are widened until the share
of them found reaches the recall asked for.

Nearness is the largest inner product. One more component, the square root of M² - |x|²
with M the largest norm, makes all vectors as long as M, and the largest inner product the
least distance, so that the tree can split by distance.

Equal vectors are one class. Their scores are equal for every query, and ties go to the
smaller id, so of a class only the k + 1 rows of smallest ids can be among a query's k
nearest others: those are indexed, and no answer is lost. A class that asks is led through
the tree once, for its k + 1 nearest rows of all; each asking row then drops its own. So
many copies of one vector cost neither candidates nor visits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.tables import cut, extended, with_row

_CLASS = ("c1", "c2")  # 128 bits of hash that equal vectors share

SAMPLE_ROWS = 20_000  # about as many rows the tree is fitted on, or more for many leaves
ROWS_A_LEAF = 8  # sampled rows a leaf, at least
CALIBRATION_QUERIES = 200  # about as many queries have their true neighbours found
MOST_LEAVES = 16_384  # bounds the sample too: about ROWS_A_LEAF times as many rows
BLOCK_ROWS = 8192
BLOCK_QUERIES = 4096


@dataclass
class Tree:
    """Nodes by number; ``leaf`` is -1 for inner nodes."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0
    norm: float = 1.0

    def stored(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes them all equally long."""
        rest = np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0.0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def distances(self, node: int, x: np.ndarray) -> np.ndarray:
        """Squared distances, less |x|², to the centres of a node's children."""
        c = np.stack([self.centres[i] for i in self.children[node]])
        return (c * c).sum(axis=1) - 2.0 * (x @ c.T)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of stored vectors is led to."""
        out = np.zeros(len(x), np.int32)
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            side = self.distances(node, x[rows]).argmin(axis=1)
            open_ += [(child, rows[side == i]) for i, child in enumerate(self.children[node])
                      if (side == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in the order that a priority queue of branches gives, best first."""
        long = np.sqrt((query * query).sum())
        q = np.append(query * (self.norm / long), 0.0)[None, :]
        heap = [(0.0, 0)]
        while heap:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
                continue
            for d, child in zip(self.distances(node, q)[0].tolist(), self.children[node], strict=True):
                heapq.heappush(heap, (d, child))


def _kmeans(x: np.ndarray, k: int, draw: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centres of at most k clusters; fewer if there are fewer different rows."""
    centres = x[draw.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        side = ((centres * centres).sum(axis=1) - 2.0 * (x @ centres.T)).argmin(axis=1)
        used = np.unique(side)
        centres = np.stack([x[side == i].mean(axis=0) for i in used])
    return np.unique(centres, axis=0)


def fit(sample: np.ndarray, norm: float, leaf_rows: int, branches: int = 8, seed: int = 5) -> Tree:
    """A tree whose leaves hold about ``leaf_rows`` of the sample's rows or fewer."""
    tree, draw = Tree(norm=norm), np.random.default_rng(seed)
    x = tree.stored(sample)
    open_ = [(tree.add(x.mean(axis=0)), np.arange(len(x)))]
    while open_:
        node, rows = open_.pop()
        centres = _kmeans(x[rows], branches, draw) if len(rows) > leaf_rows else np.empty((0, 0))
        if len(centres) < 2:
            tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
            continue
        tree.children[node] = [tree.add(c) for c in centres]
        side = tree.distances(node, x[rows]).argmin(axis=1)
        open_ += [(child, rows[side == i]) for i, child in enumerate(tree.children[node])]
    return tree


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is not null, not empty, not zero and all finite numbers.

    Of vectors of several lengths those of the commonest take part (ties: the longest).
    """
    v = F.col(column)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    good = vectors.where(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0.0))
    length = good.groupBy(F.size(v).alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).limit(1).collect()
    return good.where(F.size(v) == (length[0]["d"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def best(
    queries: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, own=None, seen=None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query, (places, scores) of its k best rows of ``x``, ties to smaller ids.

    Scores are sums of products in double precision, in one order for all rows, so that
    equal vectors have equal scores; the matrix product only narrows the choice.
    ``own[i]`` is the place of query i's own row, or -1; ``seen[i]`` marks the rows that
    query i looks at (None: all).
    """
    for start in range(0, len(queries), 128):
        rough = queries[start:start + 128] @ x.T
        for i, row in enumerate(rough, start):
            if own is not None and own[i] >= 0:
                row[own[i]] = -np.inf
            if seen is not None:
                row[~seen[i]] = -np.inf
            n = min(k, len(row))
            least = np.partition(row, len(row) - n)[len(row) - n]
            slack = 1e-9 * (1.0 + np.abs(least))
            near = np.flatnonzero((row >= least - slack) & (row > -np.inf))
            scores = (x[near] * queries[i]).sum(axis=1)
            order = np.lexsort((ids[near], -scores))[:k]
            yield near[order], scores[order]


def _exact(index: DataFrame, queries: list, k: int) -> DataFrame:
    """(q, __row, leaf, score): the k best rows for each of a few queries, by brute force."""
    q = np.array([r["v"] for r in queries], np.float64)
    rows = np.array([r["__row"] for r in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, ids = _matrix(batch.column("v")), batch.column("vec_id").fill_null(-1).to_numpy()
            at = batch.column("__row").to_numpy()
            place = {r: i for i, r in enumerate(at.tolist())}
            own = [place.get(r, -1) for r in rows.tolist()]
            found = list(best(q, x, ids, k, own))
            n = [len(f[0]) for f in found]
            near = np.concatenate([f[0] for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(q)), n), pa.int32()), batch.column("leaf").take(pa.array(near)),
                 batch.column("vec_id").take(pa.array(near)),
                 pa.array(np.concatenate([f[1] for f in found]))], ["q", "leaf", "vec_id", "score"])

    rows_ = index.select("__row", "vec_id", "v", "leaf").mapInArrow(
        run, "q int, leaf int, vec_id bigint, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return rows_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrate(tree: Tree, index: DataFrame, queries: list, k: int, recall: float) -> int:
    """The least number of leaf visits with which ``recall`` of the true neighbours are found.

    ``queries``: rows (__row, v), a bounded number.
    """
    if not queries:
        return 1
    order = []
    for r in queries:
        place = np.empty(tree.leaves, np.int64)
        for n, leaf in enumerate(tree.visits(np.array(r["v"], np.float64))):
            place[leaf] = n
        order.append(place)
    needed = np.sort([order[r["q"]][r["leaf"]] for r in _exact(index, queries, k).select("q", "leaf").collect()])
    if not len(needed):
        return 1
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def _answers(met: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of every asking row, from the k + 1 nearest of its class."""
    found = F.struct((-F.col("score")).alias("s"), "vec_id", F.col("row").alias("r"))
    lists = met.groupBy(*_CLASS).agg(F.sort_array(F.collect_list(found)).alias("found"))
    # A hot class's asking rows meet one row here; adaptive execution splits them.
    others = F.slice(F.filter("found", lambda x: x["r"] != F.col("__row")), 1, k)
    return asks.select(*_CLASS, "__row", F.col("vec_id").alias("query_id")).join(lists, list(_CLASS)).select(
        "query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"),
        (-F.col("x.s")).alias("score"))


def search(
    vectors: DataFrame, is_query, k: int = 20, recall: float = 0.95, leaf_rows: int = 1000,
    sample_rows: int = SAMPLE_ROWS, calibration: int = CALIBRATION_QUERIES,
    most_leaves: int = MOST_LEAVES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    ``vectors``: vec_id, embedding; queries are its rows where the column expression
    ``is_query`` holds, candidates all rows but the query's own. Nearness is the inner
    product in double precision, ties go to the smaller vec_id. A query gets k rows, or
    all candidates if there are fewer.

    Leaves hold ``leaf_rows`` rows or so, up to ``most_leaves`` leaves, and larger ones
    beyond. The tree is fitted on about ``sample_rows`` rows, or 8 a leaf if that is more.

    Vectors that are null, empty, zero or hold a null or a number that is not finite take
    no part, nor do those of another length than most; repeated rows are rows of their
    own, and a null id sorts first among ties; other columns are ignored; no rows give
    no rows.
    """
    spark = vectors.sparkSession
    rows = with_row(vectors).select("__row", "vec_id", F.col("embedding").alias("v"),
                                    F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = cut(usable(rows, "v").withColumns(
        {"c1": F.xxhash64(F.lit(1), "v"), "c2": F.xxhash64(F.lit(2), "v")}))
    # The group limit runs in the map tasks too, so a hot class shuffles k + 1 rows a task.
    place = F.row_number().over(Window.partitionBy(*_CLASS).orderBy("vec_id", "__row"))
    kept = cut(rows.withColumn("__n", place).where(F.col("__n") <= k + 1).select(
        "__row", "vec_id", "v", *_CLASS, (F.col("__n") == 1).alias("first")))
    asking = cut(rows.where("asks").select(*_CLASS, "__row", "vec_id"))
    # One row for each class that asks; its vector is that of the class's first row.
    askers = asking.groupBy(*_CLASS).agg(F.min("__row").alias("asker"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = kept.agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("norm2")).first()
    out = "query_id bigint, rank int, vec_id bigint, score double"
    classes = askers.count()
    if not facts["n"] or not classes:
        return spark.createDataFrame([], out)
    draw = F.pmod(F.xxhash64("__row"), F.lit(1 << 20))
    leaves = min(most_leaves, facts["n"] / leaf_rows)
    share = min(1.0, max(sample_rows, ROWS_A_LEAF * leaves) / facts["n"])
    drawn = kept.where(draw < share * (1 << 20)).select("v").toArrow().column("v").combine_chunks()
    sample = _matrix(drawn) if len(drawn) else np.array([kept.first()["v"]], np.float64)
    own_rows = max(leaf_rows, facts["n"] / most_leaves) * min(1.0, len(sample) / facts["n"])
    tree = fit(sample, float(np.sqrt(facts["norm2"])), max(ROWS_A_LEAF, int(own_rows)))
    shared = spark.sparkContext.broadcast(vars(tree))

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**shared.value)
        for batch in batches:
            if len(batch):
                leaf = tree.find(tree.stored(_matrix(batch.column("v"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    index = cut(kept.mapInArrow(led, extended(kept, "leaf int")))
    counts = np.zeros(tree.leaves, np.int64)
    for r in index.groupBy("leaf").count().collect():  # a row for each leaf
        counts[r["leaf"]] = r["count"]
    asks = cut(askers.join(index.where("first").select(*_CLASS, "v"), list(_CLASS)))
    part = min(1.0, calibration / classes)
    chosen = asks.where(F.pmod(F.xxhash64("asker", F.lit(1)), F.lit(1 << 20)) < part * (1 << 20))
    visits = calibrate(tree, index, chosen.select(F.col("asker").alias("__row"), "v").collect(), k, recall)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**shared.value)
        for batch in batches:
            groups, leaves, at = [], [], []
            for i, q in enumerate(_matrix(batch.column("v")) if len(batch) else ()):
                seen, visited = 0, {}
                for n, leaf in enumerate(tree.visits(q)):
                    if n >= visits and seen > k:
                        break
                    seen += counts[leaf]
                    visited.setdefault(int(group_of[leaf]), []).append(leaf)
                groups += visited.keys()
                leaves += visited.values()
                at += [i] * len(visited)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[c.take(take) for c in batch.columns], pa.array(groups, pa.int32()),
                 pa.array(leaves, pa.list_(pa.int32()))], [*batch.schema.names, "g", "leaves"])

    # Neighbouring leaves make a group of about BLOCK_ROWS rows, which is met at once; a
    # query looks in it at the leaves that it visits. A larger leaf is a group of its own.
    group_of = (np.cumsum(counts) - 1) // BLOCK_ROWS
    probes = cut(asks.mapInArrow(walked, extended(asks, "g int, leaves array<int>")))
    groups = spark.createDataFrame([(i, int(g)) for i, g in enumerate(group_of)], "leaf int, g int")
    held = index.select("__row", "vec_id", "v", "leaf").join(F.broadcast(groups), "leaf")  # a row for each leaf
    # Blocks of a group's vectors and of the queries that visit it.
    sizes = held.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("nv")).join(
        probes.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("nq")), "g")
    return _answers(_met(held, probes, sizes, k + 1), asking, k)


def _met(held: DataFrame, probes: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """(c1, c2, row, vec_id, score): the k best rows of the leaves that each class visits."""
    asked = probes.join(sizes, "g").select(
        "g", "leaves", F.pmod(F.xxhash64("asker"), F.col("nq")).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("vb"), *_CLASS, "v")
    held = held.join(sizes, "g").select(
        "g", "leaf", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"),
        F.pmod(F.xxhash64("__row"), F.col("nv")).cast("int").alias("vb"), "__row", "vec_id", "v")

    def meet(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"c1": [], "c2": [], "row": [], "vec_id": [], "score": []})
        x = x.sort_values("__row", ignore_index=True)  # rows of one id and score: by number
        ids = x["vec_id"].fillna(-1).to_numpy(np.int64)
        found = list(best(np.stack(q["v"].to_list()).astype(np.float64),
                          np.stack(x["v"].to_list()).astype(np.float64), ids, k, None,
                          [np.isin(x["leaf"].to_numpy(), visited) for visited in q["leaves"]]))
        n = [len(f[0]) for f in found]
        near = np.concatenate([f[0] for f in found])
        return pd.DataFrame({
            "c1": np.repeat(q["c1"].to_numpy(), n), "c2": np.repeat(q["c2"].to_numpy(), n),
            "row": x["__row"].to_numpy()[near], "vec_id": x["vec_id"].to_numpy()[near],
            "score": np.concatenate([f[1] for f in found])})

    keys = ["g", "qb", "vb"]
    met = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
        meet, "c1 bigint, c2 bigint, row bigint, vec_id bigint, score double")
    order = Window.partitionBy(*_CLASS).orderBy(F.desc("score"), "vec_id", "row")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")
