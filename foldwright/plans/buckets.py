"""Order-preserving buckets for a numeric, date or timestamp column.

A total order over a whole table cannot go through one task, so rows are first
dealt into consecutive value ranges. The limits are approximate quantiles
computed in one pass; they decide the balance only, never the result. A value
so frequent that it fills several ranges owns a bucket, and that bucket is cut
again along the tie column. As each tie range also holds about 1/B of all rows,
no bucket exceeds that share, whatever the distribution looks like. This is the
first level: where that share is still more than a task should sort, callers cut
buckets further (``ranks``, ``cuts``).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.functions.dates import micros
from foldwright.functions.scalars import numbers
from foldwright.plans.size import shuffle_width

ROWS_PER_BUCKET = 2_000
MAX_BUCKETS = 4_096
#: Bucket limits of a larger table are estimated from about this many of its rows.
LIMIT_ROWS = 5_000_000
EXACT_DOUBLE = 2.0**53
# whatever is ordered may be a score of another operator, so these names are used here only
BUCKET = "__fw_bucket"
SUB = "__fw_sub_bucket"
_ORDER = "__fw_bucket_order"
_TIE = "__fw_bucket_tie"


def as_double(df: DataFrame, name: str) -> Column:
    """A double in the same order as the column (exact for the usual ranges)."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(df, name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    raise TypeError(f"column '{name}' of type {kind.simpleString()} has no numeric order")


def is_ordinal(df: DataFrame, name: str) -> bool:
    kind = df.schema[name].dataType
    return isinstance(
        kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )


@dataclass
class Buckets:
    """Limits for one ordering, and the projection that applies them."""

    order: str
    tie: str | None
    descending: bool
    rows: int
    splits: list[float] = field(default_factory=list)
    owned: list[int] = field(default_factory=list)
    tie_splits: list[float] = field(default_factory=list)
    tie_words: list[str] = field(default_factory=list)

    def place(self, df: DataFrame) -> DataFrame:
        """Add the bucket and sub-bucket columns; nulls form the last bucket."""
        last = len(self.splits) + 2
        position = as_double(df, self.order)
        out = df.withColumn(_ORDER, -position if self.descending else position)
        if self.splits:
            out = Bucketizer(
                splits=[-math.inf, *self.splits, math.inf],
                inputCol=_ORDER,
                outputCol=BUCKET,
                handleInvalid="keep",
            ).transform(out)
            out = out.withColumn(BUCKET, F.coalesce(F.col(BUCKET).cast("int"), F.lit(last)))
        else:
            out = out.withColumn(BUCKET, F.when(F.col(_ORDER).isNull(), last).otherwise(0))
        split_again = F.col(BUCKET).isin([*self.owned, last])
        if self.tie_splits:
            out = out.withColumn(_TIE, as_double(df, self.tie))
            out = Bucketizer(
                splits=[-math.inf, *self.tie_splits, math.inf],
                inputCol=_TIE,
                outputCol=SUB,
                handleInvalid="keep",
            ).transform(out)
            sub = F.coalesce(F.col(SUB).cast("int"), F.lit(-1))
            out = out.withColumn(SUB, F.when(split_again, sub).otherwise(0)).drop(_TIE)
        elif self.tie_words:
            words = F.array(*[F.lit(w) for w in self.tie_words])
            sub = F.size(F.filter(words, lambda w: w <= F.col(self.tie)))
            out = out.withColumn(SUB, F.when(split_again, sub).otherwise(0))
        else:
            out = out.withColumn(SUB, F.lit(0))
        return out.drop(_ORDER)

    def sort_columns(self) -> list[Column]:
        first = F.col(self.order)
        keys = [first.desc_nulls_last() if self.descending else first.asc_nulls_last()]
        if self.tie is not None:
            keys.append(F.col(self.tie).asc())
        return keys


def _thin(values: list[float], wanted: int) -> list[float]:
    if wanted <= 1 or not values:
        return []
    step = len(values) / wanted
    return [values[min(len(values) - 1, int(step * i))] for i in range(1, wanted)]


def _resolution(df: DataFrame) -> int:
    return min(MAX_BUCKETS, max(256, 4 * shuffle_width(df.sparkSession)))


def _for_limits(df: DataFrame) -> tuple[DataFrame, int | None]:
    """The rows to estimate limits from, and the row count if it had to be taken.

    Of a large table a sample is enough: limits decide the balance only.
    """
    rows = df.count()
    return (df if rows <= LIMIT_ROWS else df.sample(LIMIT_ROWS / rows, 7)), rows


def _limits(quantiles: list[float] | None, count: int) -> tuple[list[float], list[float]]:
    """Splits for ``count`` buckets, and the values that fill several of them."""
    cuts = _thin([v for v in (quantiles or []) if not math.isnan(v)], count)
    repeats = Counter(cuts)
    points: set[float] = set()
    owners: list[float] = []
    for value in sorted(repeats):
        points.add(value)
        if repeats[value] > 1 and abs(value) < EXACT_DOUBLE:
            owners.append(value)
            points.add(math.nextafter(value, math.inf))
    return sorted(points), owners


def order_buckets(
    df: DataFrame,
    order: str,
    tie: str | None = None,
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Buckets:
    """Limits for ``(order, tie)``: one aggregate over two columns, one row back."""
    most = _resolution(df)
    shares = numbers([i / most for i in range(1, most)])
    position = as_double(df, order)
    wanted = [
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(-position if descending else position, shares, 10_000).alias("o"),
    ]
    numeric_tie = tie is not None and is_ordinal(df, tie)
    if numeric_tie:
        wanted.append(F.percentile_approx(as_double(df, tie), shares, 10_000).alias("t"))
    source, rows = _for_limits(df)
    found = source.agg(*wanted).first()
    rows = found["n"] if rows is None else rows
    count = max(1, min(most, math.ceil(rows / rows_per_bucket)))
    if count == 1:
        return Buckets(order, tie, descending, rows)
    points, owners = _limits(found["o"], count)
    limits = Buckets(order, tie, descending, rows, points, [points.index(v) + 1 for v in owners])
    if tie is not None:
        if numeric_tie:
            limits.tie_splits = sorted(set(_thin(list(found["t"] or []), count)))
        elif owners:
            limits.tie_words = word_limits(df, tie, rows)
    return limits


def column_buckets(df: DataFrame, cols: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, Buckets]:
    """Limits of several numeric columns, each ordered on its own, from one aggregate."""
    most = _resolution(df)
    shares = numbers([i / most for i in range(1, most)])
    wanted = [F.percentile_approx(as_double(df, c), shares, 10_000).alias(f"q{i}") for i, c in enumerate(cols)]
    source, rows = _for_limits(df)
    found = source.agg(F.count(F.lit(1)).alias("n"), *wanted).first()
    rows = found["n"] if rows is None else rows
    count = max(1, min(most, math.ceil(rows / rows_per_bucket)))
    limits = {}
    for i, c in enumerate(cols):
        points = _limits(found[f"q{i}"], count)[0] if count > 1 else []
        limits[c] = Buckets(c, None, False, rows, points)
    return limits


def word_limits(df: DataFrame, tie: str, rows: int, wanted: int = 256) -> list[str]:
    """About ``wanted`` string limits from a bounded sample (balance only)."""
    share = min(1.0, 16.0 * wanted / max(rows, 1))
    seen = sorted(r[0] for r in df.select(tie).sample(share, 7).limit(32 * wanted).collect() if r[0] is not None)
    return sorted(set(_thin(seen, wanted)))
