"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves and each half is quantised by its own codebook of
64 centroids, so 64 x 64 cells form the index.  A query walks the pairs of
centroids from best to worst by the sum of its two halves' inner products with
them, with a heap over the two sorted lists (each pop opens at most two pairs),
until the cells passed hold the stated share of all vectors.  The entries of
these cells are reranked by the true inner product in double precision.

Bounded: the codebooks and the share are fitted on a sample of ``max_sample``
vectors; the share is the smallest whose recall, against brute force within the
sample, reaches ``recall`` for a sample of queries (a larger index has nearer
neighbours, so there the same share recalls more).  Cell sizes are 4096 numbers.

Distributed: entries go out in blocks of ``block`` vectors of one first centroid;
a query goes to the blocks it needs with one 64-bit mask of second centroids for each
first one.  A cell of any size is spread over many blocks.  Each block returns at
most ``k`` entries for a query, which are merged by query.

Defined results: null ids and null, empty, zero, non-finite or partly null vectors
take no part, nor do vectors of another length than the most frequent (ties: the longer); of rows
that repeat an id the smallest vector counts; ties go to the smaller vec_id;
fewer candidates than ``k`` give fewer rows; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import bounded_sample, cut, shuffle_partitions

CENTROIDS = 64


@dataclass
class Index:
    dims: int
    books: tuple[np.ndarray, np.ndarray]
    share: float
    cells: np.ndarray | None = None  # entries in each pair of centroids

    @property
    def half(self) -> int:
        return (self.dims + 1) // 2

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = x[:, : self.half], x[:, self.half :]
        return tuple((p @ c.T - 0.5 * (c**2).sum(axis=1)).argmax(axis=1) for p, c in zip(parts, self.books))

    def visit(self, query: np.ndarray, want: int) -> np.ndarray:
        """For each first centroid the mask of second ones to look into: pairs by falling sum until they hold ``want`` entries."""
        near = [c @ q for c, q in zip(self.books, (query[: self.half], query[self.half :]))]
        order = [np.argsort(-s, kind="stable").tolist() for s in near]
        first, second = ([float(s[i]) for i in o] for s, o in zip(near, order))
        sizes = self.cells.tolist()
        masks = [0] * CENTROIDS
        held, heap, opened = 0, [(-(first[0] + second[0]), 0, 0)], [0] * len(first)
        while heap and held < want:
            _, i, j = heapq.heappop(heap)
            a, b = order[0][i], order[1][j]
            masks[a] |= 1 << b
            held += sizes[a][b]
            opened[i] = j + 1
            # A pair is opened when both its better neighbours have been passed.
            if i + 1 < len(first) and opened[i + 1] == j:
                heapq.heappush(heap, (-(first[i + 1] + second[j]), i + 1, j))
            if j + 1 < len(second) and (i == 0 or opened[i - 1] > j + 1):
                heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        return np.array(masks, np.uint64)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of the rows of ``x``; starts from rows spread over the sample; fewer rows than ``k`` repeat."""
    c = x[np.arange(k) * max(1, len(x)) // k % len(x)].copy()
    for _ in range(rounds):
        of = (x @ c.T - 0.5 * (c**2).sum(axis=1)).argmax(axis=1)
        count = np.bincount(of, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
    return c


def fit(sample: np.ndarray, recall: float, k: int) -> Index:
    """Codebooks, and the share of the entries to look at, from a bounded sample."""
    dims = sample.shape[1]
    half = (dims + 1) // 2
    index = Index(dims, (kmeans(sample[:, :half], CENTROIDS), kmeans(sample[:, half:], CENTROIDS)), 1.0)
    queries = sample[:: max(1, len(sample) // 200)]
    a, b = index.assign(sample)
    true = queries @ sample.T
    summed = (queries[:, :half] @ index.books[0].T)[:, a] + (queries[:, half:] @ index.books[1].T)[:, b]
    k = min(k + 1, len(sample))  # a query finds itself as well
    best = np.argpartition(-true, k - 1, axis=1)[:, :k]
    rank = (summed[:, None, :] >= np.take_along_axis(summed, best, axis=1)[:, :, None]).mean(axis=2)
    index.share = float(min(1.0, np.quantile(rank, recall)))
    return index


def usable(vector: str = "embedding") -> Column:
    """Neither null nor zero, and every component a finite number."""
    fine = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda v: F.coalesce(v != 0, F.lit(False))), F.lit(False))


def _matrix(column: pa.Array, dims: int, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims).astype(kind)


def _pack(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("embedding").to_pylist(), np.float64).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([v.tobytes() for v in x], pa.binary())], names=["vec_id", "vector"])

    return run


def top(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` greatest scores, ties to the smaller id, best first."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= edge)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _rerank(dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids, second = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["second"], np.uint8)
                x = np.frombuffer(r["vectors"], np.float64).reshape(-1, dims)
                query_ids, masks = np.frombuffer(r["query_ids"], np.int64), np.frombuffer(r["masks"], np.uint64)
                queries = np.frombuffer(r["queries"], np.float64).reshape(-1, dims)
                bits = np.uint64(1) << second.astype(np.uint64)
                rough = queries @ x.T
                for i, (query, mask) in enumerate(zip(query_ids, masks)):
                    at = np.flatnonzero(((mask & bits) != 0) & (ids != query))
                    if not len(at):
                        continue
                    if len(at) > k:  # the product of matrices rounds by place: take what could be among the best and compute it again
                        s = rough[i, at]
                        at = at[s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-9 * max(1.0, float(np.abs(s).max()))]
                    exact = (x[at] * queries[i]).sum(axis=1)
                    best = top(exact, ids[at], k)
                    rows.append((int(query), ids[at][best].tobytes(), exact[best].tobytes()))
            if rows:
                q, v, s = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.binary()), pa.array(s, pa.binary())], names=["query_id", "ids", "scores"])

    return run


def _merge(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for q, v, s in zip(*(batch.column(c).to_pylist() for c in ("query_id", "ids", "scores"))):
                v, s = np.frombuffer(v, np.int64), np.frombuffer(s, np.float64)
                if q in best:
                    v, s = np.concatenate([best[q][0], v]), np.concatenate([best[q][1], s])
                    at = top(s, v, k)
                    v, s = v[at], s[at]
                best[q] = (v, s)
        items = list(best.items())
        for at in range(0, len(items), 1000):
            part = items[at : at + 1000]
            n = [len(v) for _, (v, _) in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([q for q, _ in part], n)),
                    pa.array(np.concatenate([np.arange(1, m + 1) for m in n]).astype(np.int32)),
                    pa.array(np.concatenate([v for _, (v, _) in part])),
                    pa.array(np.concatenate([s for _, (_, s) in part])),
                ],
                names=["query_id", "rank", "vec_id", "score"],
            )

    return run


RESULT = "query_id long, rank int, vec_id long, score double"


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95, max_sample: int = 10_000, block: int = 8192, seed: int = 5
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query row among all other rows of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("vec_id").isNotNull() & usable())
    if not rows.groupBy("vec_id").count().filter("count > 1").isEmpty():
        rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    common = rows.groupBy(F.size("embedding").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return spark.createDataFrame([], RESULT)
    dims = common["dims"]
    rows = rows.filter(F.size("embedding") == dims)
    sample = bounded_sample(rows, ["vec_id"], max_sample, seed).mapInArrow(_pack(dims), "vec_id long, vector binary").select("vector").collect()
    rows = rows.mapInArrow(_pack(dims), "vec_id long, vector binary")
    index = fit(np.frombuffer(b"".join(r[0] for r in sample), np.float64).reshape(-1, dims), recall, k)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = index.assign(_matrix(batch.column("vector"), dims))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["vec_id", "vector", "first", "second"])

    entries = cut(rows.mapInArrow(assign, "vec_id long, vector binary, first int, second int"), "imi-entries")
    index.cells = np.zeros((CENTROIDS, CENTROIDS), np.int64)
    for r in entries.groupBy("first", "second").count().collect():
        index.cells[r["first"], r["second"]] = r["count"]
    whole = int(index.cells.sum())
    want = int(np.ceil(index.share * whole))
    # Blocks of each first centroid: enough that none passes ``block`` by much; entries are dealt by their id's hash.
    blocks = np.maximum(1, -(-index.cells.sum(axis=1) // block)).tolist()
    dealt = F.element_at(F.array(*[F.lit(int(n)) for n in blocks]), F.col("first") + 1)

    def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for f, p, v, x, s in zip(*(batch.column(c).to_pylist() for c in ("first", "part", "vec_id", "vector", "second"))):
                held.setdefault((f, p), []).append((v, x, s))
        for (f, p), items in held.items():
            v, x, s = zip(*items)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f], pa.int32()), pa.array([p], pa.int32()), pa.array([np.array(v, np.int64).tobytes()], pa.binary()), pa.array([b"".join(x)], pa.binary()), pa.array([bytes(s)], pa.binary())],
                names=["first", "part", "ids", "vectors", "second"],
            )

    parts = shuffle_partitions(spark)
    entry_blocks = (
        entries.withColumn("part", F.pmod(F.xxhash64("vec_id"), dealt).cast("int")).repartition(parts, "first", "part").mapInArrow(block_rows, "first int, part int, ids binary, vectors binary, second binary")
    )

    def query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                ids = piece.column("vec_id").to_numpy(zero_copy_only=False)
                x = _matrix(piece.column("vector"), dims)
                masks = np.array([index.visit(q, want) for q in x]).reshape(-1, CENTROIDS)
                rows = []
                for f in range(CENTROIDS):
                    use = masks[:, f] != 0
                    if use.any():
                        rows += [(f, p, ids[use].tobytes(), x[use].tobytes(), masks[use, f].tobytes()) for p in range(blocks[f])]
                f, p, i, q, m = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f, pa.int32()), pa.array(p, pa.int32()), pa.array(i, pa.binary()), pa.array(q, pa.binary()), pa.array(m, pa.binary())],
                    names=["first", "part", "query_ids", "queries", "masks"],
                )

    # The walk is the costly part of a query: deal the queries out evenly first.
    queries = entries.filter(is_query).select("vec_id", "vector").repartition(parts, "vec_id").mapInArrow(query_rows, "first int, part int, query_ids binary, queries binary, masks binary")
    met = queries.join(entry_blocks, ["first", "part"])
    found = met.mapInArrow(_rerank(dims, k), "query_id long, ids binary, scores binary")
    return found.repartition(parts, "query_id").mapInArrow(_merge(k), RESULT)
