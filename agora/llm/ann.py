"""Nearest neighbours by largest inner product with an inverted multi-index.

Both halves of the vectors are quantised separately; a pair of centroids is a cell, and every vector is an entry of one
cell. A search walks over the pairs of centroids by summed distance, with a heap, until the cells hold the entries that
it may read, and reranks those by their inner product in double precision.

The centroids are fitted to a bounded sample (``SAMPLE`` vectors in the mean); every vector is indexed. How many entries
a search reads follows from a measurement: for ``PROBES`` of the queries, the true neighbours among all vectors are found
by brute force, and the smallest share of entries is taken that holds ``recall`` of them. Vectors without structure need
large shares; clustered ones small.

Entries lie in blocks of about ``BLOCK`` vectors with one first centroid, queries in blocks of at most ``QUERIES``; a pair
of blocks is one product of matrices. A block, not a cell, is the unit of work, so a cell that holds a third of all
vectors is spread over many tasks.

Vectors that are null, zero, of another length than most, or that hold null or non-finite numbers take no part, nor do
rows without an id. Rows that repeat an id are entries each; as queries they are searched once. Other columns play no
part.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agora.session import materialize

CENTROIDS = 64
SAMPLE = 16384
PROBES = 128
BLOCK = 1024
QUERIES = 512
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


@dataclass(frozen=True)
class Quantiser:
    """Centroids of the two halves."""

    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of both halves to their centroids, less the halves' own squares."""
        cut = self.first.shape[1]
        halves = ((vectors[:, :cut], self.first), (vectors[:, cut:], self.second))
        return tuple((c * c).sum(axis=1) - 2.0 * (half @ c.T) for half, c in halves)

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(d.argmin(axis=1) for d in self.distances(vectors))


def _centroids(points: np.ndarray, count: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's rounds from ``count`` of the points; empty centroids stay where they are."""
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:count]].copy()
    for _ in range(rounds):
        nearest = ((centres * centres).sum(axis=1) - 2.0 * (points @ centres.T)).argmin(axis=1)
        for k in range(len(centres)):
            own = points[nearest == k]
            if len(own):
                centres[k] = own.mean(axis=0)
    return centres


def train(sample: np.ndarray, centroids: int = CENTROIDS, seed: int = 0) -> Quantiser:
    count = max(1, min(centroids, math.isqrt(len(sample) // 4)))
    cut = (sample.shape[1] + 1) // 2
    return Quantiser(_centroids(sample[:, :cut], count, seed), _centroids(sample[:, cut:], count, seed + 1))


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by summed distance: the multi-sequence order, on a heap of the pairs that border the walk."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        _, i, j = heapq.heappop(heap)
        yield a[i], b[j]
        # (i, j) follows (i, j - 1) in its row; a row is opened by the first pair of the row before.
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def visited(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, entries: float) -> np.ndarray:
    """Which cells (first, second) a search reads until they hold ``entries``."""
    out = np.zeros(sizes.shape, dtype=bool)
    read = 0
    for i, j in walk(first, second):
        out[i, j] = True
        read += int(sizes[i, j])
        if read >= entries:
            break
    return out


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key (long) and vector (doubles) of the rows that take part, written once."""
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("key").isNotNull() & _usable(F.col("vector")))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return rows.where(F.size("vector") == (sizes[0]["size"] if sizes else 0))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _top(ids: np.ndarray, matrix: np.ndarray, query: np.ndarray, own: int, rough: np.ndarray, k: int) -> list[tuple[int, float]]:
    """The k nearest entries of a block by exact inner product; ``rough`` may be off by rounding."""
    rough = np.where(ids == own, -np.inf, rough)
    if len(rough) > k:
        least = np.partition(rough, len(rough) - k)[len(rough) - k]
        pick = np.flatnonzero(rough >= least - 1e-9 * max(1.0, abs(least)) if np.isfinite(least) else rough > -np.inf)
    else:
        pick = np.flatnonzero(rough > -np.inf)
    # One sum for each row in one order: equal vectors get equal scores, wherever they lie.
    scores = (matrix[pick] * query).sum(axis=1)
    order = np.lexsort((ids[pick], -scores))[:k]
    return [(int(ids[pick[o]]), float(scores[o])) for o in order]


def _pairs(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score, cell: of each pair of blocks, the k nearest entries of each query in visited cells."""
    blocks = index.groupBy("first", "block").agg(F.collect_list(F.struct("key", "second", "vector")).alias("entries"))
    asked = queries.groupBy("first", "query_block").agg(F.collect_list(F.struct("query_id", "query", "seconds")).alias("asked"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for entries, asked, first in zip(frame["entries"], frame["asked"], frame["first"]):
                ids = np.array([e["key"] for e in entries], dtype=np.int64)
                seconds = np.array([e["second"] for e in entries], dtype=np.int64)
                matrix = np.array([e["vector"] for e in entries], dtype=np.float64)
                wanted = np.array([q["query"] for q in asked], dtype=np.float64)
                rough = wanted @ matrix.T
                for q, query, row in zip(asked, wanted, rough):
                    open_ = np.zeros(1 + max(int(seconds.max()), max(q["seconds"])), dtype=bool)
                    open_[np.asarray(q["seconds"], dtype=np.int64)] = True
                    inside = np.flatnonzero(open_[seconds])
                    if len(inside):
                        for vec, s in _top(ids[inside], matrix[inside], query, q["query_id"], row[inside], k):
                            out.append((q["query_id"], vec, s, first))
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score", "first"])

    joined = blocks.join(asked, "first").select("first", "entries", "asked")
    # Few rows, each of them large: one at a time goes to Python.
    return joined.mapInPandas(score, "query_id long, vec_id long, score double, first int")


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _share(rows: DataFrame, index: DataFrame, sizes: np.ndarray, quantiser: Quantiser, probes: DataFrame, k: int, recall: float) -> float:
    """The smallest share of the entries that holds ``recall`` of the probes' true neighbours."""
    asked = probes.select(F.col("key").alias("query_id"), F.col("vector").alias("query")).dropDuplicates(["query_id"]).collect()
    if not asked:
        return 1.0
    spark = rows.sparkSession
    every = list(range(sizes.shape[1]))
    schema = "first int, query_block int, query_id long, query array<double>, seconds array<int>"
    data = [(i, 0, r["query_id"], r["query"], every) for r in asked for i in range(sizes.shape[0])]
    truth = _nearest(_pairs(index, spark.createDataFrame(data, schema), k), k)
    keys = index.select(F.col("key").alias("vec_id"), "first", "second").dropDuplicates(["vec_id"])
    hits: dict[int, list[tuple[int, int]]] = {}
    for r in truth.join(keys, "vec_id").select("query_id", "first", "second").collect():
        hits.setdefault(r["query_id"], []).append((r["first"], r["second"]))
    needs = []
    first, second = quantiser.distances(np.array([r["query"] for r in asked]))
    for r, a, b in zip(asked, first, second):
        reads, read = np.zeros(sizes.shape), 0
        for i, j in walk(a, b):
            reads[i, j] = read  # what is read before this cell is opened
            read += int(sizes[i, j])
        needs += [reads[cell] for cell in hits.get(r["query_id"], [])]
    total = sizes.sum()
    return next((s for s in SHARES if np.mean(np.array(needs) < s * total) >= recall), 1.0) if needs else 1.0


def search(
    vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.94
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found for each row where ``queries`` (over key) holds."""
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, key, vector)
    total = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    row_hash = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    picked = rows.where(row_hash < max(1, int((1 << 30) * min(1.0, SAMPLE / total)))).select("row", "vector").collect()
    if not picked:
        picked = rows.orderBy("row").limit(1).select("row", "vector").collect()
    quantiser = train(np.array([r["vector"] for r in sorted(picked, key=lambda r: r["row"])], dtype=np.float64))

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                frame["first"], frame["second"] = quantiser.assign(_matrix(frame["vector"]))
                yield frame[["key", "row", "vector", "first", "second"]]

    assigned = materialize(
        rows.select("key", "row", "vector").mapInPandas(cells, "key long, row long, vector array<double>, first int, second int"),
        "cells",
    )
    sizes = np.zeros((len(quantiser.first), len(quantiser.second)), dtype=np.int64)
    for r in assigned.groupBy("first", "second").count().collect():  # bounded: the pairs of centroids
        sizes[r["first"], r["second"]] = r["count"]
    blocks = np.maximum(1, np.ceil(sizes.sum(axis=1) / BLOCK)).astype(int).tolist()
    n_blocks = F.element_at(F.array(*map(F.lit, blocks)), F.col("first") + 1)
    index = assigned.withColumn("block", F.pmod(F.xxhash64("row"), n_blocks.cast("long")).cast("int"))

    asked = rows.where(queries)
    n_asked = asked.count()
    if not n_asked:
        return empty
    probe_hash = F.pmod(F.xxhash64("row", F.lit("probe")), F.lit(1 << 30))
    probes = asked.where(probe_hash < max(1, int((1 << 30) * min(1.0, PROBES / n_asked))))
    entries = _share(rows, index, sizes, quantiser, probes, k, recall) * total

    def walks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            if len(frame):
                first, second = quantiser.distances(_matrix(frame["query"]))
                for query_id, query, own, a, b in zip(frame["query_id"], frame["query"], frame["own"], first, second):
                    # The query's own rows are skipped: ``k`` others are read all the same.
                    cells = visited(a, b, sizes, max(entries, k + own))
                    out += [(i, query_id, query, np.flatnonzero(cells[i])) for i in np.flatnonzero(cells.any(axis=1))]
            yield pd.DataFrame(out, columns=["first", "query_id", "query", "seconds"])

    once = asked.groupBy(F.col("key").alias("query_id")).agg(F.first("vector").alias("query"), F.count(F.lit(1)).alias("own"))
    walked = once.mapInPandas(walks, "first int, query_id long, query array<double>, seconds array<int>")
    query_blocks = math.ceil(n_asked / (QUERIES // 2))
    walked = walked.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int"))
    return _nearest(_pairs(index, walked, k), k)


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The result of the query: the rows whose id is divisible by ``every``, searched among all others."""
    return search(vectors, F.col("key") % every == 0, k=k)
