"""Exact order statistics of a whole table, so that rows need not be ranked.

To deal rows into blocks of a global order it is enough to know the key of the
first row of each block. Those keys are found by counting rows per bucket and
looking inside the few buckets that hold a wanted position. Every row is then
placed by comparing its own key with a handful of literals: no row is shuffled,
and the placement is a plain expression that Spark can push down or repeat.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.plans.buckets import BUCKET, ROWS_PER_BUCKET, SUB, Buckets, order_buckets
from foldwright.plans.ranks import seeded_hash
from foldwright.session import stage

#: A cell that holds a wanted position is refined or dealt out so that one task sorts no more rows than this.
BUCKET_ROWS = 1_000_000
_HASH, _CLASS = "__fw_h", "__fw_class"
HASH_DIGITS = 32
#: hex digits of the hash that one level adds
CELL_DIGITS = 3

Positions = Callable[[int], Sequence[int]]
#: Positions within a class as an array, from the column that holds the class's rows.
ClassPositions = Callable[[Column], Column]


def hash_cuts(df: DataFrame, seed: int, ids: Sequence[str], positions: ClassPositions, by: str | None = None) -> DataFrame:
    """``(__fw_class, n, cuts)``: each class's rows and the hash at its ``positions(n)``, null past the end.

    One row for each class, any number of classes. Jobs read the id and class
    columns only. A level counts the rows of a cell by three more digits of the
    hash, at most 4,096 cells for one class or cell, and only cells that hold a
    wanted position go on, until a cell has no more distinct hashes than one task
    sorts with ease. Rows of equal hash (ids that repeat or are null) are counted
    and not sorted.
    """
    label = F.col(by) if by is not None else F.lit(None).cast("string")
    rows = df.select(seeded_hash(seed, *ids).alias(_HASH), label.alias(_CLASS))
    cells = rows.groupBy(F.col(_CLASS).alias("c"), F.substring(_HASH, 1, CELL_DIGITS).alias("p")).agg(F.count(F.lit(1)).alias("m"))
    whole = Window.partitionBy("c")
    cells = cells.withColumn("n", F.sum("m").over(whole)).withColumn("before", _before(whole, "p"))
    cells = cells.withColumn("inside", _within(positions(F.col("n"))))
    # the first cell of a class brings its size
    cells = cells.filter((F.size("inside") > 0) | (F.col("before") == 0))
    cells = _kept(cells, by)
    # no Observation: it leaves a manager in the session that cannot be serialised, and summaries of Spark's models name the session
    total, most = cells.agg(F.sum(F.when(F.col("before") == 0, F.col("n"))), F.max("m")).first()
    # a sixteenth of the limit, as hashes are even only on average
    needed = math.ceil(math.log(max(1, 16 * (total or 0) / BUCKET_ROWS), 16))
    held, digits = cells.filter(F.size("inside") > 0), CELL_DIGITS
    while digits < min(needed, HASH_DIGITS) and (most or 0) > BUCKET_ROWS:
        held = _kept(_finer(rows, held, digits, digits + CELL_DIGITS), by)
        digits, most = digits + CELL_DIGITS, held.agg(F.max("m")).first()[0]
    found = _finer(rows, held, digits, HASH_DIGITS).select("c", F.lit(None).cast("long").alias("n"), F.explode("inside").alias("w"), "p")
    sizes = cells.filter("before = 0").select("c", "n", F.lit(None).cast("long").alias("w"), F.lit(None).cast("string").alias("p"))
    known = found.union(sizes).groupBy(F.col("c").alias(_CLASS)).agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_set(F.when(F.col("w").isNotNull(), F.struct("w", "p")))).alias("found")
    )
    known = known.select(_CLASS, "n", F.transform(positions(F.col("n")), lambda w: F.try_element_at("found", w)).alias("cuts"))
    # without classes there is one row, which is read once
    return known if by is None else stage(known, "class-cuts")


def _kept(cells: DataFrame, by: str | None) -> DataFrame:
    """Cells that hold wanted positions, written; without classes they are as few as the positions and stay with the driver."""
    return cells.sparkSession.createDataFrame(cells.toArrow(), cells.schema) if by is None else stage(cells, "cells")


def _before(cells: WindowSpec, order: str) -> Column:
    """Rows in the cells before, of one parent."""
    return F.coalesce(F.sum("m").over(cells.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _within(wanted: Column) -> Column:
    """The wanted positions that fall into a cell."""
    return F.filter(wanted, lambda w: (w >= F.col("before")) & (w < F.col("before") + F.col("m")))


def _finer(rows: DataFrame, held: DataFrame, digits: int, more: int) -> DataFrame:
    """The cells of ``more`` digits inside those of ``digits`` that hold a wanted position."""
    parents = held.select("c", F.col("p").alias("q"), F.col("before").alias("start"), F.col("inside").alias("asked"))
    inner = rows.join(parents, F.col(_CLASS).eqNullSafe(F.col("c")) & (F.substring(_HASH, 1, digits) == F.col("q")))
    cells = inner.groupBy("c", "q", "start", "asked", F.substring(_HASH, 1, more).alias("p")).agg(F.count(F.lit(1)).alias("m"))
    cells = cells.withColumn("before", F.col("start") + _before(Window.partitionBy("c", "q"), "p"))
    return cells.select("c", "p", "m", "before", _within(F.col("asked")).alias("inside")).filter(F.size("inside") > 0)


def with_block(df: DataFrame, cuts: DataFrame, seed: int, ids: Sequence[str], name: str, by: str | None = None) -> DataFrame:
    """Add how many of its class's cuts a row's hash has reached: a block number.

    Without classes the cuts become literals. With classes they are joined as a
    table, which Spark broadcasts when it is small.
    """
    if by is None:
        limits = (cuts.first() or {"cuts": []})["cuts"]
        number = F.lit(0)
        for limit in limits:
            if limit is not None:
                number = number + (F.col(_HASH) >= F.lit(limit)).cast("int")
        # a column of its own, so that the hash is computed once per row
        return df.withColumn(_HASH, seeded_hash(seed, *ids)).withColumn(name, number).drop(_HASH)
    hashed = df.withColumn(_HASH, seeded_hash(seed, *ids))
    passed = F.size(F.filter("cuts", lambda c: F.coalesce(c <= F.col(_HASH), F.lit(False))))
    joined = hashed.join(cuts.select(F.col(_CLASS), "cuts"), F.col(by).eqNullSafe(F.col(_CLASS)), "left")
    return joined.select(*df.columns, passed.cast("int").alias(name))


# --------------------------------------------------------------- ordered cuts


def _portable(name: str, kind: T.DataType) -> Column:
    """A form of the value that survives the driver, whatever its time zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    return F.col(name).cast("string") if isinstance(kind, T.TimestampNTZType) else F.col(name)


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


@dataclass(frozen=True)
class OrderCuts:
    """The ``(order, tie)`` key at each wanted position of ``n`` ordered rows."""

    order: str
    tie: str
    descending: bool
    n: int
    keys: dict[int, tuple[Any, Any]]
    kinds: tuple[T.DataType, T.DataType]

    def before(self, position: int) -> Column:
        """Whether a row lies strictly before ``position``."""
        if position <= 0:
            return F.lit(False)
        if position >= self.n:
            return F.lit(True)
        value, tie = self.keys[position]
        order, earlier = F.col(self.order), F.col(self.tie) < _literal(tie, self.kinds[1])
        if value is None:
            return order.isNotNull() | earlier
        limit = _literal(value, self.kinds[0])
        ahead = order > limit if self.descending else order < limit
        return F.coalesce(ahead | ((order == limit) & earlier), F.lit(False))


def order_cuts(
    df: DataFrame,
    order: str,
    tie: str,
    positions: Positions,
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> OrderCuts:
    """Keys at ``positions(n)`` in ``(order, tie)`` order; jobs read these two columns only."""
    slim = df.select(order, tie)
    kinds = (slim.schema[order].dataType, slim.schema[tie].dataType)
    limits = order_buckets(slim, order, tie, descending, rows_per_bucket)
    n = limits.rows
    wanted = {p: p for p in positions(n) if 0 < p < n}
    keys = _keys_at(slim, limits, wanted, kinds, rows_per_bucket) if wanted else {}
    return OrderCuts(order, tie, descending, n, keys, kinds)


def _keys_at(
    slim: DataFrame, limits: Buckets, wanted: dict[int, int], kinds: tuple[T.DataType, T.DataType], rows_per_bucket: int
) -> dict[int, tuple[Any, Any]]:
    """The keys of ``wanted``, which maps positions inside ``slim`` to the names they go by.

    A cell of too many rows is cut again on its own, down to cells that one task
    can sort or that cannot be told apart.
    """
    placed = limits.place(slim)
    # sub-buckets start at -1
    cell = F.col(BUCKET).cast("long") * 1_000_000 + F.col(SUB)
    cells = placed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    asked = F.array(*[F.lit(p).cast("long") for p in sorted(wanted)])
    inside = F.filter(asked, lambda w: (w >= F.col("before")) & (w < F.col("before") + F.col("n")))
    held = cells.withColumn("inside", inside).filter(F.size("inside") > 0).collect()
    keys: dict[int, tuple[Any, Any]] = {}
    small = [c for c in held if c["n"] <= BUCKET_ROWS or c["n"] == limits.rows]
    for c in held:
        if c not in small:
            part = placed.filter(cell == c["cell"]).select(*slim.columns)
            finer = order_buckets(part, limits.order, limits.tie, limits.descending, rows_per_bucket)
            keys |= _keys_at(part, finer, {p - c["before"]: wanted[p] for p in c["inside"]}, kinds, rows_per_bucket)
    if small:
        names = {(c["cell"], p - c["before"]): wanted[p] for c in small for p in c["inside"]}
        few = placed.withColumn("__fw_cell", cell).filter(F.col("__fw_cell").isin([c["cell"] for c in small]))
        at = F.row_number().over(Window.partitionBy("__fw_cell").orderBy(*limits.sort_columns())) - 1
        few = few.withColumn("__fw_i", at).filter(F.col("__fw_i").isin(sorted({i for _, i in names})))
        shown = [_portable(limits.order, kinds[0]).alias("o"), _portable(limits.tie, kinds[1]).alias("t")]
        for r in few.select("__fw_cell", "__fw_i", *shown).collect():
            if (r[0], r[1]) in names:
                keys[names[r[0], r[1]]] = (r[2], r[3])
    return keys
