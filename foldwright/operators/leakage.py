"""Leakage checks (L1-L5). Every check is a table ``(check, subject, value, flagged)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scalars import numeric_columns
from foldwright.operators.lookup import overlap
from foldwright.operators.windows import ahead_rolling_mean


def _lines(row: DataFrame, check: str, values: dict[str, Column], limit: float, absolute: bool) -> DataFrame:
    cells = []
    for subject, value in values.items():
        size = F.abs(value) if absolute else value
        cells.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(subject).alias("subject"),
                value.cast("double").alias("value"),
                F.coalesce(size > F.lit(limit), F.lit(False)).alias("flagged"),
            )
        )
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def target_leakage(
    df: DataFrame, target: str, features: Sequence[str] | None = None, threshold: float = 0.95
) -> DataFrame:
    """Correlation of every numeric feature with the target; one aggregate."""
    features = numeric_columns(df, [target]) if features is None else list(features)
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in features])
    return _lines(row, "target", {c: F.col(c) for c in features}, threshold, absolute=True)


def duplicate_rows(train: DataFrame, test: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Row pairs that train and test share."""
    found = overlap(train, test, exclude)
    return _lines(found, "duplicates", {"rows": F.col("n_pairs")}, 0.0, absolute=False)


def group_leakage(df: DataFrame, group: str, target: str, threshold: float = 0.9) -> DataFrame:
    """Share of groups whose target does not vary (one-row groups cannot be constant)."""
    per_group = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        F.var_samp(F.col(target).cast("double")).alias("v")
    )
    row = per_group.agg(F.count(F.when(F.col("v") == 0, 1)).alias("still"), F.count(F.lit(1)).alias("total"))
    return _lines(row, "group", {group: F.try_divide("still", "total")}, threshold, absolute=False)


def temporal_leakage(
    df: DataFrame, time: str, tie: str, features: Sequence[str], threshold: float = 0.99, **options
) -> DataFrame:
    """Correlation of each feature with its own mean over the rows ahead."""
    ahead = ahead_rolling_mean(df.select(time, tie, *features), time, tie, features, **options)
    row = ahead.agg(*[F.corr(F.col(c).cast("double"), F.col(f"{c}_ahead")).alias(c) for c in features])
    return _lines(row, "temporal", {c: F.col(c) for c in features}, threshold, absolute=False)


def leakage_report(
    train: DataFrame,
    test: DataFrame | None = None,
    target: str | None = None,
    group: str | None = None,
    time: str | None = None,
    tie: str | None = None,
    features: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """All applicable checks in one table."""
    skip = [c for c in (target, group, time, tie) if c is not None]
    features = numeric_columns(train, skip) if features is None else list(features)
    parts = []
    if target is not None:
        parts.append(target_leakage(train, target, features))
    if test is not None:
        parts.append(duplicate_rows(train, test, exclude))
    if group is not None and target is not None:
        parts.append(group_leakage(train, group, target))
    if time is not None:
        if tie is None:
            raise ValueError("the temporal check needs a tie column")
        parts.append(temporal_leakage(train, time, tie, features))
    if not parts:
        raise ValueError("nothing to check")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
