"""Small column expressions used across operators."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Added to denominators of ratio features.
RATIO_FLOOR = 1e-8


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column: missing is null from here on."""
    fixes = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(fixes) if fixes else df


def numbers(values: Sequence[float]) -> Column:
    """An array literal, parsed at once instead of built element by element."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def bin_number(col: str, edges: Sequence[float]) -> Column:
    """How many of a few edges lie strictly below the value; null for null."""
    name = "`" + col.replace("`", "``") + "`"
    steps = " + ".join([f"if({name} > {float(e)!r}D, 1, 0)" for e in edges] or ["0"])
    return F.expr(f"if({name} is null, null, {steps})")


def ratio(value: Column, base: Column) -> Column:
    """``value / (base + 1e-8)``; null instead of an error when that is zero."""
    return F.try_divide(value, base + F.lit(RATIO_FLOOR))


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def clip_probability(p: Column) -> Column:
    return clip(p, 1e-7, 1 - 1e-7)


def decision(p: Column, cut: float = 0.5) -> Column:
    return (p > F.lit(cut)).cast("int")


def uniform_from_hash(seed: int, stream: str, *ids: Column) -> Column:
    """A repeatable uniform in (0, 1) per row and stream."""
    digest = F.md5(F.concat_ws("_", F.lit(f"{seed}_{stream}"), *[i.cast("string") for i in ids]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(16**13))


def normal_from_hash(seed: int, stream: str, *ids: Column) -> Column:
    """A repeatable standard normal per row (Box-Muller on two hashes)."""
    u = uniform_from_hash(seed, stream + "u", *ids)
    v = uniform_from_hash(seed, stream + "v", *ids)
    return F.sqrt(-2.0 * F.ln(u)) * F.cos(F.lit(2.0 * math.pi) * v)


def numeric_columns(df: DataFrame, skip: list[str] | None = None) -> list[str]:
    skip = skip or []
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]
