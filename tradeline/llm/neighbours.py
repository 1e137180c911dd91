"""Nearest neighbours by largest inner product: inverted lists with an adaptive dimension scan.

Vectors get one more component, so that the nearest by distance is the largest by inner product, and are
turned by a random rotation. Lists are the cells of centroids, fitted on a bounded sample; every vector
is indexed. The sample also tells how many lists must be probed to find ``recall`` of its neighbours.
Lists are gathered into groups of about ``GROUP`` vectors (a longer list is split), and a query goes
once to each group that holds one of its lists. There queries read the probed vectors together, in blocks of columns.
After each block a test compares the distance so far, scaled up, with the k-th best: the share of a
squared distance that lies in d of D rotated components varies by sqrt(2 (D - d) / (d (D + 2))), and
candidates that are too far by ``z`` of these deviations are abandoned. What is left is scored exactly, in
double precision on the original vectors.

Equal vectors are indexed once, with their k + 1 smallest ids: more are never among the k nearest of
another row. So a vector that a third of all rows share is no hot group.

Cases: rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components,
take no part; nor do vectors of another length than the most frequent (the shorter, if tied). Repeated
ids count once for each different vector. With fewer than k candidates all are returned. Ties go to the
smaller id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeline.llm.common import cut, map_batches

SAMPLE, MOST_LISTS, GROUP, BLOCK = 20_000, 4096, 4096, 16
#: Partitions that groups are dealt into at most. Their number is given, as the work is not in the bytes.
MOST_PARTITIONS = 10_000
#: Vectors whose nearness to all lists is worked out at a time; queries times vectors that are compared at a time.
SLICE, PAIRS = 256, 1 << 18


@dataclass
class Index:
    """Rotation, centroids and probing depth; its size depends on the dimension only."""

    rotation: np.ndarray
    bound: float
    centroids: np.ndarray
    probes: int
    #: First group of each list, groups that it is split over, and its vectors.
    first: np.ndarray | None = None
    splits: np.ndarray | None = None
    sizes: np.ndarray | None = None

    def turned(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Rotated vectors with the additional component."""
        more = 0 * x[:, 0] if query else np.sqrt(np.maximum(self.bound - (x * x).sum(axis=1), 0))
        return np.c_[x, more] @ self.rotation

    def nearest_lists(self, turned: np.ndarray) -> np.ndarray:
        """How near each list is; the largest is the nearest."""
        return turned @ self.centroids.T - 0.5 * (self.centroids**2).sum(axis=1)

    def own_lists(self, x: np.ndarray) -> np.ndarray:
        """The list that each vector belongs to."""
        parts = [x[i : i + SLICE] for i in range(0, len(x), SLICE)]
        return np.concatenate([self.nearest_lists(self.turned(p, query=False)).argmax(axis=1) for p in parts])


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, vector of the rows that take part."""
    value = F.col("vector")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(value, lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("vector") == (size["size"] if size else 0)).distinct()


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """node (smallest id), vector, ids (the k + 1 smallest) of each different vector."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("node", F.col("ids")[0])


def _sampled(vectors: DataFrame, n: int, sample: int) -> np.ndarray:
    share = min(1.0, sample / max(n, 1))
    chosen = vectors.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share * 1_000_000)
    return _matrix(chosen.orderBy("node").select("vector").toArrow()["vector"].combine_chunks())


def fit(vectors: DataFrame, k: int, recall: float, sample: int = SAMPLE, seed: int = 11) -> Index | None:
    """Centroids and probing depth from a sample of about ``sample`` vectors; None for an empty table."""
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    facts = vectors.agg(F.count("*").alias("n"), F.max(square).alias("bound")).first()
    if not facts["n"]:
        return None
    x = _sampled(vectors, facts["n"], sample)
    if not len(x):  # a few vectors may all miss the sample
        x = _matrix(vectors.limit(100).select("vector").toArrow()["vector"].combine_chunks())
    rng = np.random.default_rng(seed)
    size = x.shape[1] + 1
    rotation, _ = np.linalg.qr(rng.normal(size=(size, size)))
    index = Index(rotation, facts["bound"] * (1 + 1e-9), np.zeros((1, size)), 1)
    turned = index.turned(x, query=False)
    lists = int(np.clip(2 * np.sqrt(facts["n"]), 1, min(MOST_LISTS, max(1, len(x) // 8))))
    index.centroids = turned[rng.choice(len(x), lists, replace=False)]
    for _ in range(10):
        near = index.nearest_lists(turned).argmax(axis=1)
        total = np.zeros_like(index.centroids)
        np.add.at(total, near, turned)
        n = np.bincount(near, minlength=lists)
        index.centroids = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], index.centroids)
    # The k nearest of all are about as near as this many of the sample.
    index.probes = _probes(index, x, turned, -(-k * len(x) // facts["n"]), recall, rng)
    return index


def _probes(index: Index, x: np.ndarray, turned: np.ndarray, k: int, recall: float, rng) -> int:
    """Lists that hold ``recall`` of the neighbours which sampled vectors have in the sample."""
    some = rng.choice(len(x), min(300, len(x)), replace=False)
    score = x[some] @ x.T
    score[np.arange(len(some)), some] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1:
        return len(index.centroids)
    best = np.argpartition(-score, k - 1, axis=1)[:, :k]
    own = index.nearest_lists(turned).argmax(axis=1)[best]
    order = np.argsort(-index.nearest_lists(index.turned(x[some], query=True)), axis=1)
    place = np.argsort(order, axis=1)
    return int(np.quantile(np.take_along_axis(place, own, axis=1), recall)) + 1


def assign_groups(index: Index, sizes: np.ndarray) -> None:
    """Small lists share a group, long ones are split over several."""
    index.sizes = sizes
    index.splits = np.maximum(1, -(-sizes // GROUP))
    index.first = np.zeros(len(sizes), np.int64)
    group = filled = 0
    for i, size in enumerate(sizes):
        if filled and (filled + size > GROUP):
            group, filled = group + 1, 0
        index.first[i] = group
        if index.splits[i] > 1:
            group, filled = group + int(index.splits[i]), 0
        else:
            filled += int(size)


class _Group:
    """The vectors of one group: column blocks of rotated ones, originals, list of each."""

    def __init__(self, rows: list[tuple], index: Index):
        self.nodes = np.array([r[0] for r in rows])
        self.lists = np.array([r[1] for r in rows])
        self.original = np.array([r[2] for r in rows], np.float64)
        turned = index.turned(self.original, query=False).astype(np.float32)
        self.size = turned.shape[1]
        edges = [*range(0, self.size, BLOCK), self.size]
        self.edges = list(zip(edges, edges[1:], strict=False))
        self.blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in self.edges]
        self.squares = [(block**2).sum(axis=1) for block in self.blocks]

    def search(self, vectors: np.ndarray, turned: np.ndarray, probed: list[np.ndarray], k: int, z: float):
        """Query (by place), node and score of the k best in the lists that each query probes.

        Blocks of columns are taken for all queries and vectors at once until most pairs are abandoned, then for
        the pairs that are left.
        """
        alive = np.array([np.isin(self.lists, own) for own in probed])
        first = slice(*self.edges[0])
        so_far = self._distances(0, turned[:, first])
        so_far[~alive] = np.inf
        # The k nearest by the first columns, measured whole, bound the distance of the k-th nearest.
        few = min(k, len(self.nodes))
        near = np.argpartition(so_far, few - 1, axis=1)[:, :few]
        whole = np.zeros(near.shape, np.float32)
        for (low, high), block in zip(self.edges, self.blocks, strict=True):
            step = block[near] - turned[:, None, low:high]
            whole += np.einsum("ijk,ijk->ij", step, step)
        whole[~np.take_along_axis(alive, near, axis=1)] = np.inf
        limit = whole.max(axis=1) if few == k else np.full(len(turned), np.inf, np.float32)
        most = (limit * np.float32(1 + 1e-4) + np.float32(1e-6))[:, None]
        query = at = distance = None
        for number, (low, high) in enumerate(self.edges):
            # What is left at the end needs no test but its distance, with room for rounding.
            scale = self._scale(high, z) if high < self.size else np.float32(1)
            if at is None:
                if number:
                    so_far += self._distances(number, turned[:, low:high])
                alive &= so_far * scale <= most
                left = np.count_nonzero(alive)
                if left <= alive.size // 16 or high == self.size:  # few are left: these by themselves
                    query, at = np.nonzero(alive)
                    distance = so_far[query, at]
            else:
                step = self.blocks[number][at] - turned[query, low:high]
                distance = distance + np.einsum("ij,ij->i", step, step)
                stay = distance * scale <= most[query, 0]
                query, at, distance = query[stay], at[stay], distance[stay]
        # Exact scores for the k nearest and what rounding may have put behind them.
        order = np.lexsort((distance, query))
        query, at, distance = query[order], at[order], distance[order]
        first = np.searchsorted(query, np.arange(len(turned)))
        last = np.minimum(first + k - 1, len(query) - 1)
        if len(query):
            enough = np.bincount(query, minlength=len(turned)) >= k
            bound = np.where(enough, distance[last] * np.float32(1 + 1e-4) + np.float32(1e-6), np.inf)
            stay = distance <= bound[query]
            query, at = query[stay], at[stay]
        score = (self.original[at] * vectors[query]).sum(axis=1)
        order = np.lexsort((self.nodes[at], -score, query))
        query, at, score = query[order], at[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        return query[place < k], self.nodes[at[place < k]], score[place < k]

    def _scale(self, known: int, z: float) -> np.float32:
        """Factor that makes a distance in ``known`` columns a low estimate of the whole one."""
        spread = np.sqrt(2 * (self.size - known) / (known * (self.size + 2)))
        return np.float32(self.size / known * max(0.0, 1 - z * spread))

    def _distances(self, number: int, turned: np.ndarray) -> np.ndarray:
        """Squared distances of all queries and vectors in one block of columns."""
        both = (-2 * turned) @ self.blocks[number].T
        both += (turned**2).sum(axis=1)[:, None]
        both += self.squares[number]
        return both


def _search(vectors: DataFrame, queries: DataFrame, index: Index, k: int, z: float) -> DataFrame:
    """query, node, score: the k best different vectors of each group probed."""

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = index.own_lists(_matrix(batch.column("vector")))
        return pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(own, pa.int32()), batch.column("vector")], ["node", "list", "vector"]
        )

    placed = cut(map_batches(vectors.select("node", "vector"), place, "node long, list int, vector array<double>"))
    sizes = np.zeros(len(index.centroids), np.int64)
    for row in placed.groupBy("list").agg(F.count("*").alias("n")).collect():  # at most MOST_LISTS
        sizes[row["list"]] = row["n"]
    assign_groups(index, sizes)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.column("list").to_numpy()
        node = batch.column("node").to_numpy()
        mixed = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        group = index.first[own] + (mixed.astype(np.int64) % index.splits[own])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1), pa.int32()), batch.column("list"))
        return pa.RecordBatch.from_arrays(
            [pa.array(group), pa.array(np.zeros(len(own), np.int32)), batch.column("node"), lists, batch.column("vector")],
            ["group", "side", "node", "lists", "vector"],
        )

    def ask(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column("vector"))
        groups, rows, lists = [], [], []
        for i in range(len(x)):
            if i % SLICE == 0:
                near = index.nearest_lists(index.turned(x[i : i + SLICE], query=True))
                order = np.argsort(-near, axis=1, kind="stable")
            nearest_first = order[i % SLICE]
            enough = int(np.searchsorted(np.cumsum(index.sizes[nearest_first]), 4 * k)) + 1
            probed = nearest_first[: max(index.probes, enough)]
            first, splits = index.first[probed], index.splits[probed]
            found: dict[int, list[int]] = {}
            for number, start, n in zip(probed.tolist(), first.tolist(), splits.tolist(), strict=True):
                for group in range(start, start + n):
                    found.setdefault(group, []).append(number)
            groups.extend(found)
            lists.extend(found.values())
            rows.extend([i] * len(found))
        at = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(groups, pa.int64()), pa.array(np.ones(len(rows), np.int32)), batch.column("node").take(at),
                pa.array(lists, pa.list_(pa.int32())), batch.column("vector").take(at),
            ],
            ["group", "side", "node", "lists", "vector"],
        )

    schema = "group long, side int, node long, lists array<int>, vector array<double>"
    both = map_batches(placed, deal, schema).unionByName(map_batches(queries.select("node", "vector"), ask, schema))
    groups = int((index.first + index.splits).max())
    both = both.repartition(min(groups, MOST_PARTITIONS), "group").sortWithinPartitions("group", "side", "node")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, group = None, [], None
        waiting: list[tuple] = []

        def answered() -> pa.RecordBatch:
            names, lists, vectors = zip(*waiting, strict=True)
            x = np.array(vectors)
            turned = index.turned(x, query=True).astype(np.float32)
            query, node, score = group.search(x, turned, [np.array(own) for own in lists], k, z)
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(names, np.int64)[query]), pa.array(node, pa.int64()), pa.array(score)], ["query", "node", "score"]
            )

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for own, side, name, lists, vector in zip(*columns, strict=True):
                if own != number:
                    if waiting:
                        yield answered()
                    number, held, group = own, [], None
                if side == 0:
                    held.append((name, lists[0], vector))
                    continue
                if not held and group is None:
                    continue
                if group is None:
                    group, held = _Group(held, index), []
                waiting.append((name, lists, vector))
                if len(waiting) * len(group.nodes) >= PAIRS:
                    yield answered()
        if waiting:
            yield answered()

    return both.mapInArrow(scan, "query long, node long, score double")


def _best(rows: DataFrame, by: str, order: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest(
    rows: DataFrame,
    k: int = 20,
    every: int = 20,
    recall: float = 0.96,
    z: float = 2.5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    rows = cut(usable(rows, id_col, vector_col))
    vectors = cut(distinct_vectors(rows, k))
    asked = rows.where(F.col("vec_id") % every == 0)
    index = fit(vectors, k, recall)
    if index is None:
        empty = "query_id long, rank int, vec_id long, score double"
        return rows.sparkSession.createDataFrame([], empty)
    names = cut(asked.join(vectors.select("vector", "node"), "vector").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")))
    queries = vectors.join(names.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
    found = _best(_search(vectors, queries, index, k + 1, z), "query", "node", k + 1).drop("rank")
    found = found.join(vectors.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    found = _best(found, "query", "vec_id", k + 1).drop("rank")
    found = found.join(names, "query").where("vec_id <> query_id")
    return _best(found, "query_id", "vec_id", k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
