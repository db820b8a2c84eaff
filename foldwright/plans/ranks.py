"""Exact ranks and running sums over a whole table, without a one-task sort.

Rows are dealt into ranges of the order, ranges with more rows than a task
should sort are cut into ranges of their own, level by level, and both forms
number rows inside the final cells and add the total of the cells before. The
number of cells follows the rows, so no task grows with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.plans.buckets import BUCKET, ROWS_PER_BUCKET, SUB, Buckets, is_ordinal, order_buckets, word_limits
from foldwright.session import stage

_NULL_KEY = "\u0000"
#: rows that one task sorts with ease; a cell of more is cut again
CELL_ROWS = 1_000_000
_WAYS = 64
_SIZE, _BY_ORDER = "__fw_n", "__fw_by"


def seeded_hash(seed: int, *ids: str) -> Column:
    """The row's place in a seeded shuffle: md5 of seed and id, equal in every engine.

    Several ids are told apart by their lengths, and null from every text.
    """
    parts = [F.col(c).cast("string") for c in ids]
    if len(parts) > 1:
        parts = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("null")) for p in parts]
    return F.md5(F.concat_ws("_", F.lit(str(seed)), *parts))


def _partition_keys(df: DataFrame, partition: Sequence[str]) -> tuple[DataFrame, list[str]]:
    keys = []
    for i, name in enumerate(partition):
        keys.append(f"__fw_p{i}")
        df = df.withColumn(keys[-1], F.coalesce(F.col(name).cast("string"), F.lit(_NULL_KEY)))
    return df, keys


def _steps(value: Column, splits: Column) -> Column:
    """How many splits a value has passed or met: a frequent value that is a split owns a number."""
    return F.size(F.filter(splits, lambda s: s < value)) + F.size(F.filter(splits, lambda s: s <= value))


def _splits(rows: DataFrame, group: list[str], col: str, name: str) -> Column:
    """An aggregate of about ``_WAYS`` split values of a group: quantiles, or for text an even part of a sample by hash."""
    if is_ordinal(rows, col) and not isinstance(rows.schema[col].dataType, T.BooleanType):
        return F.array_distinct(F.percentile_approx(col, [i / _WAYS for i in range(1, _WAYS)], 1_000)).alias(name)
    # about 16 values for each split, whatever the size of the group
    chosen = F.pmod(F.xxhash64(col), F.col(_SIZE)) < 16 * _WAYS
    seen = F.array_sort(F.collect_set(F.when(chosen, F.col(col))))
    return F.filter(seen, lambda _, i: i % 16 == 8).alias(name)


def _refined(
    placed: DataFrame, keys: list[str], places: list[str], order: str, tie: str | None, descending: bool, limit: int
) -> tuple[DataFrame, list[str]]:
    """Cut every cell of more than ``limit`` rows into ranges of its own, again and again until none is left.

    A cell is cut along ``order``; one that holds a single value is cut along
    ``tie``. A value met as a split owns a range, so each round parts a cell
    unless its rows cannot be told apart. There is one row of limits for every
    ``limit`` rows at most.
    """
    while True:
        group = [*keys, *places]
        ends = [f(c).alias(f"__fw_{n}_{c}") for c in [order, *([tie] if tie else [])] for n, f in (("lo", F.min), ("hi", F.max))]
        sizes = placed.groupBy(*group).agg(F.count(F.lit(1)).alias(_SIZE), *ends)
        differs = lambda c: ~F.col(f"__fw_lo_{c}").eqNullSafe(F.col(f"__fw_hi_{c}"))
        by_order = differs(order)
        big = sizes.filter(F.col(_SIZE) > limit).filter(by_order | differs(tie) if tie else by_order)
        big = stage(big.select(*group, _SIZE, by_order.alias(_BY_ORDER)), "large-cells")
        if big.isEmpty():
            return placed, places
        inside = placed.join(big, group).select(*group, _SIZE, _BY_ORDER, order, *([tie] if tie else []))
        made = [_splits(inside, group, order, "__fw_o"), *([_splits(inside, group, tie, "__fw_t")] if tie else [])]
        limits = inside.groupBy(*group, _BY_ORDER).agg(*made)
        limits = stage(limits, "cell-limits")
        number = _steps(F.col(order), F.col("__fw_o"))
        number = -number if descending else number
        if tie:
            number = F.when(F.col(_BY_ORDER), number).otherwise(_steps(F.col(tie), F.col("__fw_t")))
        deeper = f"__fw_b{len(places)}"
        columns = placed.columns
        placed = placed.join(limits, group, "left").select(*columns, F.coalesce(number, F.lit(0)).alias(deeper))
        places = [*places, deeper]


def _add_offsets(
    placed: DataFrame, keys: list[str], places: list[str], sort: list[Column], measures: dict[str, Column]
) -> DataFrame:
    cell = [*keys, *places]
    inside = Window.partitionBy(*cell).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"__fw_in_{n}") for n, m in measures.items()]
    )
    totals = placed.groupBy(*cell).agg(*[F.sum(m).alias(f"__fw_tot_{n}") for n, m in measures.items()])
    before = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = before.orderBy(*places).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *cell, *[F.coalesce(F.sum(f"__fw_tot_{n}").over(before), F.lit(0)).alias(f"__fw_off_{n}") for n in measures]
    )
    joined = local.join(offsets, cell, "left")
    for name in measures:
        joined = joined.withColumn(name, F.col(f"__fw_in_{name}") + F.col(f"__fw_off_{name}"))
    spare = [f"__fw_{part}_{n}" for n in measures for part in ("in", "off")]
    return joined.drop(*cell, *spare)


def prefix_sums(
    df: DataFrame,
    order: str,
    measures: dict[str, Column],
    partition: Sequence[str] = (),
    tie: str | None = None,
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    limits: Buckets | None = None,
    cell_rows: int | None = None,
) -> DataFrame:
    """Add, per measure, the sum over all rows strictly before in ``(order, tie)``.

    ``(partition, order, tie)`` should identify a row. Nulls in ``order`` come last.
    ``limits`` may come from another table over the same values with as many rows
    or more. Cells of more than ``cell_rows`` rows are cut further.
    """
    cell_rows = cell_rows or CELL_ROWS
    limits = limits or order_buckets(df, order, tie, descending, rows_per_bucket)
    placed, keys = _partition_keys(limits.place(df), partition)
    places = [BUCKET, SUB]
    if limits.rows > cell_rows:
        placed, places = _refined(placed, keys, places, order, tie, descending, cell_rows)
    return _add_offsets(placed, keys, places, limits.sort_columns(), measures)


def ordered_index(
    df: DataFrame,
    order: str,
    tie: str | None,
    partition: Sequence[str] = (),
    descending: bool = False,
    name: str = "index",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    cell_rows: int | None = None,
) -> DataFrame:
    """Add the 0-based position of every row in ``(order, tie)`` order; ``order`` may be a string."""
    if not is_ordinal(df, order):
        rows = df.count()
        limits = word_limits(df, order, rows, max(1, min(4_096, rows // rows_per_bucket)))
        words = F.array(*[F.lit(w) for w in limits]).cast("array<string>")
        bucket = F.when(F.col(order).isNull(), len(limits) + 1).otherwise(F.size(F.filter(words, lambda w: w <= F.col(order))))
        placed, keys = _partition_keys(df.withColumn(BUCKET, -bucket if descending else bucket), partition)
        first = F.col(order).desc_nulls_first() if descending else F.col(order).asc_nulls_last()
        sort = [first] if tie is None else [first, F.col(tie).asc()]
        places, cell_rows = [BUCKET], cell_rows or CELL_ROWS
        if rows > cell_rows:
            placed, places = _refined(placed, keys, places, order, tie, descending, cell_rows)
        return _add_offsets(placed, keys, places, sort, {name: F.lit(1).cast("long")})
    return prefix_sums(df, order, {name: F.lit(1).cast("long")}, partition, tie, descending, rows_per_bucket, cell_rows=cell_rows)
