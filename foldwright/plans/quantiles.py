"""Exact interpolated quantiles, per group or over the whole table.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. That
is right for ordinary groups and wrong for one that holds a third of the table,
so hot groups and whole tables are selected instead: count rows per value range,
find the ranges that hold the wanted ranks, and look only inside those.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.functions.scalars import numbers
from foldwright.plans.buckets import BUCKET, ROWS_PER_BUCKET, SUB, column_buckets, order_buckets
from foldwright.plans.hot import hot_keys

_STRIDE = 1_000_000


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    shares: Sequence[float],
    hot_rows: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """One row per key with, per column, the array of its quantiles at ``shares``."""
    keys, shares = list(keys), [float(s) for s in shares]
    slim = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    plain = [F.percentile(c, numbers(shares)).alias(c) for c in cols]
    if not keys:
        found = table_quantiles(slim, cols, shares)
        made = [
            F.array(*[F.lit(v).cast("double") for v in found[c]]).alias(c) for c in cols
        ]
        return df.sparkSession.range(1).select(*made)
    hot = hot_keys(slim, keys, hot_rows, sizes)
    if hot is None:
        return slim.groupBy(*keys).agg(*plain)
    cold = slim.join(F.broadcast(hot), keys, "left_anti").groupBy(*keys).agg(*plain)
    heavy = _select(slim.join(F.broadcast(hot), keys, "left_semi"), keys, cols, shares)
    return cold.unionByName(heavy)


def _cell(column: int, bucket: int) -> int:
    return column * _STRIDE + bucket


def table_quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of whole columns, a few numbers each, for all columns at once and the same way at every size.

    Limits of value ranges, rows per range, then only the rows of the ranges
    that hold a wanted rank.
    """
    limits = column_buckets(df, list(cols))
    placed, marks = df.select(*cols), {}
    for i, c in enumerate(cols):
        marks[c] = f"__fw_b{i}"
        placed = limits[c].place(placed).withColumnRenamed(BUCKET, marks[c]).drop(SUB)
    cells = F.array(
        *[F.struct(F.lit(i).alias("c"), F.col(marks[c]).alias("b"), F.col(c).alias("v")) for i, c in enumerate(cols)]
    )
    long = placed.select(F.explode(cells).alias("e")).select("e.*").filter(F.col("v").isNotNull())
    counts: dict[int, list[tuple[int, int]]] = {}
    for r in long.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(r["c"], []).append((r["b"], r["n"]))
    ranks: dict[int, list[tuple[int, int, float]]] = {}
    places: dict[tuple[int, int], tuple[int, int]] = {}
    for i, found in counts.items():
        n = sum(m for _, m in found)
        at = [s * (n - 1) for s in shares]
        ranks[i] = [(math.floor(a), math.ceil(a), a - math.floor(a)) for a in at]
        left = sorted({r for low, high, _ in ranks[i] for r in (low, high)})
        before = 0
        for b, m in sorted(found):
            while left and left[0] < before + m:
                rank = left.pop(0)
                places[(i, rank)] = (b, rank - before)
            before += m
    inner: dict[int, list[int]] = {}
    for (i, _), (b, at) in places.items():
        inner.setdefault(_cell(i, b), []).append(at)
    if not inner:
        return {c: [None] * len(shares) for c in cols}
    # equal values collapse first, so a frequent value is one row
    cell = F.col("c") * _STRIDE + F.col("b")
    few = long.filter(cell.isin(sorted(inner))).groupBy("c", "b", "v").agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(
        Window.partitionBy("c", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    few = few.withColumn("upto", upto)
    entries = ", ".join(f"{k}, array({', '.join(f'{r}L' for r in sorted(set(v)))})" for k, v in inner.items())
    asked = F.expr(f"map({entries})")
    covers = F.exists(asked[cell], lambda r: (F.col("upto") > r) & (F.col("upto") - F.col("m") <= r))
    few = few.filter(covers)
    seen: dict[tuple[int, int], list[tuple[int, float]]] = {}
    for r in few.select("c", "b", "upto", "v").collect():
        seen.setdefault((r["c"], r["b"]), []).append((r["upto"], r["v"]))

    def value(i: int, rank: int) -> float:
        b, inner = places[(i, rank)]
        return min((u, v) for u, v in seen[(i, b)] if u > inner)[1]

    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        if i not in ranks:
            out[c] = [None] * len(shares)
            continue
        out[c] = []
        for low, high, part in ranks[i]:
            a, z = value(i, low), value(i, high)
            out[c].append(a + (z - a) * part)
    return out


def _select(df: DataFrame, keys: list[str], cols: Sequence[str], shares: list[float]) -> DataFrame:
    tables = [_select_one(df, keys, c, shares) for c in cols]
    result = tables[0]
    for table in tables[1:]:
        result = result.join(table, keys, "outer")
    return result


def _select_one(df: DataFrame, keys: list[str], col: str, shares: list[float]) -> DataFrame:
    values = df.select(*keys, col).filter(F.col(col).isNotNull())
    rows = order_buckets(values, col, rows_per_bucket=ROWS_PER_BUCKET).place(values)
    cells = rows.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("__fw_n"))
    by_group = Window.partitionBy(*keys)
    cells = cells.select(
        "*",
        F.coalesce(
            F.sum("__fw_n").over(by_group.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__fw_before"),
        F.sum("__fw_n").over(by_group).alias("__fw_total"),
    )
    asked = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(high).alias("high"), (F.lit(s) * (F.col("__fw_total") - 1)).alias("at"))
            for i, s in enumerate(shares)
            for high in (False, True)
        ]
    )
    wanted = cells.select(*keys, BUCKET, "__fw_before", "__fw_n", F.explode(asked).alias("__fw_q"))
    wanted = wanted.withColumn("__fw_rank", F.when(F.col("__fw_q.high"), F.ceil("__fw_q.at")).otherwise(F.floor("__fw_q.at")))
    wanted = wanted.filter((F.col("__fw_rank") >= F.col("__fw_before")) & (F.col("__fw_rank") < F.col("__fw_before") + F.col("__fw_n")))
    wanted = wanted.select(*keys, BUCKET, "__fw_before", "__fw_q", "__fw_rank")
    # at most 2 * len(shares) rows per hot key, and hot keys are bounded
    needed = wanted.select(*keys, BUCKET).distinct()
    inside = rows.join(F.broadcast(needed), [*keys, BUCKET], "left_semi")
    inside = inside.groupBy(*keys, BUCKET, col).agg(F.count(F.lit(1)).alias("__fw_m"))
    running = Window.partitionBy(*keys, BUCKET).orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("__fw_skip", F.coalesce(F.sum("__fw_m").over(running), F.lit(0)))
    first = F.col("__fw_before") + F.col("__fw_skip")
    hits = inside.join(F.broadcast(wanted), [*keys, BUCKET]).filter(
        (F.col("__fw_rank") >= first) & (F.col("__fw_rank") < first + F.col("__fw_m"))
    )

    def pick(i: int, what: str, high: bool):
        return F.max(F.when((F.col("__fw_q.i") == i) & (F.col("__fw_q.high") == F.lit(high)), F.col(what)))

    quantiles = []
    for i in range(len(shares)):
        low, high, at = pick(i, col, False), pick(i, col, True), pick(i, "__fw_q.at", False)
        quantiles.append(low + (high - low) * (at - F.floor(at)))
    return hits.groupBy(*keys).agg(F.array(*quantiles).alias(col))
