"""Embedding whitening (operator 13): bit-sliced scatter, integer centring, eigenvectors.

An entry ``c`` becomes the integer ``floor(scale * c) + offset``. Where vectors
are read, each dimension is shifted by its least value in a block of rows and
its bits are sliced into planes: bit ``a`` of 64 rows is one word. The cross
product of two dimensions is the sum over pairs of planes of ``2**(a + b)``
times the bits set in both, which a bitwise and with a count of bits gives
exactly. Sums travel as limbs of 40 bits, so totals over any number of rows are
exact as well; the covariance is centred as integers before it becomes doubles.

What reaches the driver is one number for each pair of dimensions, whatever the
number of rows.

Rows whose vector is null or holds null, NaN or infinite entries are left out,
as are vectors of another length than the most frequent one (the shorter of
equals), which lie in another space. Integers beyond 61 bits are held there.
Rows that repeat an id, also a null one, are rows of their own. A component
without variance (constant dimensions, a single row) has null ``whitened`` and
takes no part in ``identity_error``; ``explained`` and ``identity_error`` are
null where no component has any. ``deviation`` is null where it exceeds a long.
An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.session import stage

U64 = np.uint64
#: rows of one block of planes: 128 words a plane
BLOCK_ROWS = 8_192
LIMBS, LIMB_BITS = 6, 40
LARGEST = 1 << 61
#: a component counts as constant below this share of the largest variance
FLAT = 1e-12


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes ``(dimensions, bits, words)`` of a matrix of non-negative integers, rows packed into words of 64."""
    n, d = values.shape
    bits = max(1, int(values.max(initial=0)).bit_length())
    words = -(-n // 64)
    rows = np.zeros((d, words * 64), np.int64)
    rows[:, :n] = values.T
    out = np.empty((d, bits, words), U64)
    for a in range(bits):
        out[:, a] = np.packbits(((rows >> a) & 1).astype(np.uint8), axis=1, bitorder="little").view(U64)
    return out


def cross_products(sliced: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of dimensions from their planes, as Python integers."""
    d, bits, _ = sliced.shape
    # every product of a block fits a long up to this many bits
    kind = np.int64 if 2 * bits + BLOCK_ROWS.bit_length() < 63 else object
    weight = np.array([1 << a for a in range(bits)], dtype=kind)
    out = np.zeros((d, d), object)
    for i in range(d):
        total = np.zeros(d - i, kind)
        for a in range(bits):
            both = np.bitwise_count(sliced[i:] & sliced[i, a]).sum(axis=2, dtype=np.int64).astype(kind)
            total = total + (both @ weight) * weight[a]
        out[i, i:] = out[i:, i] = total.astype(object)
    return out


def scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * c)`` as integers, held within 61 bits."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * scale), -float(LARGEST), float(LARGEST)).astype(np.int64)


@dataclass
class Scatter:
    """Row count, sums and cross products of integer vectors, all exact."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    @staticmethod
    def empty(d: int) -> Scatter:
        return Scatter(0, np.zeros(d, object), np.zeros((d, d), object))

    def add(self, x: np.ndarray) -> None:
        """Count the rows of ``x``, block by block."""
        for at in range(0, len(x), BLOCK_ROWS):
            block = x[at : at + BLOCK_ROWS]
            low = block.min(axis=0)
            shifted = block - low
            y = shifted.sum(axis=0, dtype=object) if int(shifted.max()) >> 49 else shifted.sum(axis=0).astype(object)
            low, n = low.astype(object), len(block)
            self.products = self.products + cross_products(planes(shifted)) + np.outer(low, y) + np.outer(y, low) + n * np.outer(low, low)
            self.sums = self.sums + y + n * low
            self.n += n

    def centred(self) -> np.ndarray:
        """``n`` squared times the covariance, as integers."""
        return self.n * self.products - np.outer(self.sums, self.sums)


def _limbs(value: int) -> list[int]:
    """Limbs that add up to ``value``; all but the last are not negative."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & ((1 << LIMB_BITS) - 1))
        value >>= LIMB_BITS
    return [*out, value]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def finite_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """``(id, v)`` with double entries, all finite, and their number of dimensions."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter("v is not null and size(v) > 0")
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.col("n").desc(), "d").first()
    d = first["d"] if first else 0
    return rows.filter(F.size("v") == d), d


def scatter(rows: DataFrame, d: int, scale: float) -> Scatter:
    """The scatter of ``rows(id, v)``: one partial sum for each partition and pair of dimensions, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Scatter.empty(d)
        for batch in batches:
            part.add(scaled(_matrix(batch.column(0), d), scale))
        if part.n:
            cells = [(-1, -1, part.n)] + [(i, -1, part.sums[i]) for i in range(d)]
            cells += [(i, j, part.products[i, j]) for i in range(d) for j in range(i, d)]
            limbs = np.array([_limbs(int(value)) for _, _, value in cells], dtype=np.int64)
            where = [pa.array([c[k] for c in cells], pa.int32()) for k in (0, 1)]
            names = ["i", "j", *(f"l{k}" for k in range(LIMBS))]
            yield pa.RecordBatch.from_arrays([*where, *(pa.array(limbs[:, k]) for k in range(LIMBS))], names=names)

    parts = rows.select("v").mapInArrow(run, "i int, j int, " + ", ".join(f"l{k} long" for k in range(LIMBS)))
    total = Scatter.empty(d)
    for row in parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]).collect():
        value = sum(row[2 + k] << (LIMB_BITS * k) for k in range(LIMBS))
        if row["i"] < 0:
            total.n = value
        elif row["j"] < 0:
            total.sums[row["i"]] = value
        else:
            total.products[row["i"], row["j"]] = total.products[row["j"], row["i"]] = value
    return total


def components(total: Scatter) -> tuple[np.ndarray, np.ndarray, float]:
    """Variances in falling order, unit eigenvectors as columns, and the trace; signs by the largest entry."""
    square = total.n**2
    centred = total.centred()
    # a quotient of two integers is rounded once
    covariance = np.array([[int(x) / square for x in row] for row in centred])
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    largest = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[largest, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return values, axes, int(np.trace(centred)) / square


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = 8, scale: float = 1024.0) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``: a row for each vector and component.

    The offset of the integers cancels in all of these, so it is left out.
    ``identity_error`` is measured on the whitened values themselves.
    """
    rows, d = finite_vectors(vectors, id_col, vector_col)
    kind = vectors.schema[id_col].dataType.simpleString()
    result = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if d == 0:
        return vectors.sparkSession.createDataFrame([], result)
    total = scatter(rows, d, scale)
    values, axes, trace = components(total)
    k = min(count, d)
    good = [c for c in range(k) if values[c] > FLAT * max(values[0], 0.0)]
    n, sums = total.n, total.sums
    turn = axes[:, good] / np.sqrt(values[good])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(_matrix(batch.column(1), d), scale)
            bound = n * int(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in sums)
            off = n * x - sums.astype(np.int64) if bound < 1 << 62 else n * x.astype(object) - sums
            if d * bound * bound < 1 << 62 or d * int(np.abs(off).max(initial=0)) ** 2 < 1 << 62:
                deviation = pa.array((off * off).sum(axis=1).astype(np.int64))
            else:
                exact = [int(s) for s in (off.astype(object) ** 2).sum(axis=1)]
                deviation = pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())
            white = (off / n).astype(float) @ turn
            names = ["id", "deviation", *(f"z{c}" for c in good)]
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, *(pa.array(white[:, i]) for i in range(len(good)))], names=names)

    schema = ", ".join([f"id {kind}", "deviation long", *(f"z{c} double" for c in good)])
    white = stage(rows.mapInArrow(run, schema), "whitened")
    error = None
    if good:
        off = [F.abs(F.covar_pop(f"z{a}", f"z{b}") - F.lit(1.0 if a == b else 0.0)) for a in good for b in good if a <= b]
        error = white.agg(F.array_max(F.array(*off)).alias("e")).first()["e"]
    cells = [
        F.struct(
            F.lit(c + 1).alias("component"),
            (F.col(f"z{c}") if c in good else F.lit(None).cast("double")).alias("whitened"),
            F.lit(max(float(values[c]), 0.0) / trace if trace > 0 else None).cast("double").alias("explained"),
        )
        for c in range(k)
    ]
    out = white.select("id", "deviation", F.explode(F.array(*cells)).alias("c"))
    return out.select("id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).cast("double").alias("identity_error"))
