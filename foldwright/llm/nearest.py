"""Approximate nearest neighbours (operator 4): collision counting over query-centred windows.

Every vector is projected on ``m`` random lines; each line keeps its values in
order. A query opens a window around its own value on every line and counts in
how many windows each vector falls. Windows widen step by step (virtual
rehashing: the same arrays serve every radius); vectors with enough collisions
are verified by their exact inner product, and a query ends once its ``k``-th
best lies within the radius that the windows stand for.

Inner products become distances by one more component that brings every vector
to the largest length. Vectors that are null, zero or hold null or non-finite
components take no part; vectors of another length are no candidates. Rows that
repeat an id are candidates of other ids only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwright.session import stage

#: vectors of one index
BLOCK_ROWS = 65_536
#: queries that are worth an index of their own, and how many copies of one block's index there are at most
QUERY_ROWS, COPIES = 512, 8
#: a step that adds over a part of all places in so many counts by ranks instead of places; both count the same
SPARSE = 16
#: partitions for each index, as hashes of few indexes meet in a partition otherwise
SPREAD = 4


class CollisionIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, vectors: np.ndarray, largest: float, lines: int, seed: int):
        n, d = vectors.shape
        self.largest = largest
        self.vectors = vectors
        self.lines = np.random.default_rng(seed).standard_normal((lines, d + 1))
        rest = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0))
        projected = (vectors @ self.lines[:, :d].T + np.outer(rest, self.lines[:, d])).T
        self.order = np.argsort(projected, axis=1)
        self.values = np.take_along_axis(projected, self.order, axis=1)
        kind = np.uint16 if n < 1 << 16 else np.uint32
        self.ranks = np.empty((lines, n), kind)
        np.put_along_axis(self.ranks, self.order, np.arange(n, dtype=kind)[None, :], axis=1)

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """In how many windows ``low:high`` of the lines each row lies."""
        lines, n = self.ranks.shape
        counts = np.zeros(n, np.uint8 if lines < 256 else np.uint16)
        past, inside = np.empty(n, self.ranks.dtype), np.empty(n, bool)
        for ranks, first, width in zip(self.ranks, low.astype(past.dtype), (high - low).astype(past.dtype), strict=True):
            # below the window the difference wraps round and is larger than any width
            np.subtract(ranks, first, out=past)
            np.less(past, width, out=inside)
            counts += inside.view(np.uint8)
        return counts

    def search(self, query: np.ndarray, own: np.ndarray, k: int, growth: float, need: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and inner products of about the ``k`` nearest rows, ``own`` rows left out."""
        lines, n = self.values.shape
        length = np.sqrt((query**2).sum())
        at = self.lines[:, :-1] @ (query * (self.largest / length))
        low = np.array([np.searchsorted(v, x) for v, x in zip(self.values, at, strict=True)])
        high = low.copy()
        enough = int(np.ceil(need * lines))
        counts = np.zeros(n, np.uint16)
        open_ = np.ones(n, bool)
        open_[own] = False
        room = int(open_.sum())
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        radius = 0.6 * np.sqrt(2) * self.largest
        while room:
            pieces, fresh = [], 0
            for j in range(lines):
                a = np.searchsorted(self.values[j, : low[j]], at[j] - radius, side="left")
                b = high[j] + np.searchsorted(self.values[j, high[j] :], at[j] + radius, side="right")
                pieces += [self.order[j, a : low[j]], self.order[j, high[j] : b]]
                fresh += low[j] - a + b - high[j]
                low[j], high[j] = a, b
            if fresh * SPARSE < lines * n:
                counts = counts + np.bincount(np.concatenate(pieces), minlength=n)
            else:
                counts = self.collisions(low, high)
            # two lengths apart is the most there is; then everything left is looked at
            done = radius > 2 * self.largest
            found = np.flatnonzero(open_ if done else open_ & (counts >= enough))
            open_[found] = False
            rows = np.concatenate((rows, found))
            scores = np.concatenate((scores, self.vectors.take(found, axis=0) @ query))
            if done:
                break
            if len(scores) >= k:
                worst = np.partition(scores, len(scores) - k)[len(scores) - k]
                if 2 * self.largest**2 - 2 * worst * self.largest / length <= radius**2:
                    break
            radius *= growth
        return rows, scores


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _stretches(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows of equal ``keys``."""
    found = np.stack([batch[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
    limits = [0, *(np.flatnonzero((found[:, 1:] != found[:, :-1]).any(axis=0)) + 1), batch.num_rows]
    for a, b in zip(limits[:-1], limits[1:], strict=True):
        if b > a:
            yield tuple(found[:, a].tolist()), batch.slice(a, b - a)


def nearest(vectors: DataFrame, id_col: str, vector_col: str, every: int, k: int, lines: int = 96, growth: float = 1.12, need: float = 0.618, seed: int = 7) -> DataFrame:
    """``(query_id, rank, id, score)``: for ids divisible by ``every`` the ``k`` rows of largest inner product.

    Vectors are dealt into blocks of bounded size and every query is sent to
    every block, which returns its best ``k``. A task reads a block's vectors,
    builds one index and lets the queries pass by it, however many there are, so
    what is shuffled grows with vectors plus queries times blocks. To use more
    machines on few blocks, a block has up to ``COPIES`` indexes that share its
    queries.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = stage(rows.withColumn("d", F.size("v")), "vectors")
    wanted = rows.filter(F.col("id") % every == 0)
    total = rows.agg(F.count("*").alias("n"), F.max(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)).alias("most"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    n_blocks, n_copies = -(-total["n"] // BLOCK_ROWS) or 1, min(COPIES, -(-total["q"] // QUERY_ROWS)) or 1
    largest = float(np.sqrt(total["most"] or 1.0))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = rows.select("id", "v", "d", dealt(n_blocks).alias("block"), each(n_copies).alias("copy"), F.lit(0).alias("asks"))
    asked = wanted.select("id", "v", "d", each(n_blocks).alias("block"), dealt(n_copies).alias("copy"), F.lit(1).alias("asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, index, ids = None, [], None, np.zeros(0, np.int64)
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for (*group, asks), part in _stretches(batch, [*keys, "asks"]):
                if group != now:
                    now, held, index = group, [], None
                if not asks:
                    held.append((part["id"].to_numpy(), _matrix(part["v"])))
                    continue
                if index is None and held:
                    ids, matrix = (np.concatenate(x) for x in zip(*held, strict=True))
                    held, order = [], np.argsort(ids, kind="stable")
                    ids, index = ids[order], CollisionIndex(matrix[order], largest, lines, seed)
                if index is None:
                    continue
                for query, vector in zip(part["id"].to_numpy(), _matrix(part["v"]), strict=True):
                    own = np.arange(*np.searchsorted(ids, [query, query + 1]))
                    found, scores = index.search(vector, own, k, growth, need)
                    if len(scores) > k:
                        # all that tie with the k-th best stay for the order by id
                        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        found, scores = found[near], scores[near]
                    best = np.lexsort((ids[found], -scores))[:k]
                    for to, values in zip(out, (np.full(len(best), query), ids[found[best]], scores[best]), strict=True):
                        to.append(values)
            kinds = (np.int64, np.int64, np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, kind), *x])) for kind, x in zip(kinds, out, strict=True)], names=["query_id", "id", "score"])

    keys = ["d", "block", "copy"]
    dealt_out = side.union(asked).repartition(SPREAD * n_blocks * n_copies, *keys).sortWithinPartitions(*keys, "asks")
    found = dealt_out.mapInArrow(run, "query_id long, id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
