"""Features stacked along parent-child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.operators.groupby import bias_corrected_skew, group_mode
from foldwright.plans.hot import attach

AGGREGATES = ("mean", "max", "min", "std", "count", "sum", "skew", "mode")
TRANSFORMS = ("absolute", "add", "multiply")

_MAKE = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_samp,
    "sum": F.sum,
    "skew": bias_corrected_skew,
}


def roll_up(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    name: str,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    aggregates: Sequence[str] = AGGREGATES,
    most: int | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add aggregates of the child rows to each parent row; returns the new columns too.

    Columns are named ``{stat}_{child}_{col}``; a caller may refuse more than ``most`` of them.
    """
    wanted = [(s, c) for c in numeric for s in aggregates if s in _MAKE]
    modes = [c for c in categorical if "mode" in aggregates]
    new = [f"{s}_{name}_{c}" for s, c in wanted] + [f"mode_{name}_{c}" for c in modes]
    if "count" in aggregates:
        new.append(f"count_{name}")
    if most is not None and len(new) > most:
        raise ValueError(f"{len(new)} features exceed the limit of {most}")
    keyed = child.filter(F.col(child_key).isNotNull()).withColumnRenamed(child_key, parent_key)
    made = [_MAKE[s](c).alias(f"{s}_{name}_{c}") for s, c in wanted]
    table = keyed.groupBy(parent_key).agg(F.count(F.lit(1)).alias(f"count_{name}"), *made)
    for c in modes:
        table = table.join(group_mode(keyed, [parent_key], c, f"mode_{name}_{c}"), parent_key, "left")
    sizes = table.select(parent_key, F.lit(1).cast("long").alias("__fw_n"))
    out = attach(parent, table, [parent_key], sizes=sizes)
    if "count" in aggregates:
        out = out.withColumn(f"count_{name}", F.coalesce(f"count_{name}", F.lit(0)))
    else:
        out = out.drop(f"count_{name}")
    return out, new


def pairwise_transforms(
    df: DataFrame, cols: Sequence[str], transforms: Sequence[str] = TRANSFORMS, most: int | None = None
) -> tuple[DataFrame, list[str]]:
    """Add ``absolute``, ``add`` and ``multiply`` of columns and column pairs."""
    made = {}
    if "absolute" in transforms:
        made.update({f"absolute_{c}": F.abs(c) for c in cols})
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    if "add" in transforms:
        made.update({f"{a}_plus_{b}": F.col(a) + F.col(b) for a, b in pairs})
    if "multiply" in transforms:
        made.update({f"{a}_times_{b}": F.col(a) * F.col(b) for a, b in pairs})
    if most is not None and len(made) > most:
        raise ValueError(f"{len(made)} features exceed the limit of {most}")
    return df.withColumns(made), list(made)


def difference(df: DataFrame, key: str, time: str, tie: str, col: str, hot_rows: int | None = None) -> DataFrame:
    """Add ``diff_{c}``: change from the previous row of the key."""
    from foldwright.plans.chunks import halo_windows

    return halo_windows(
        df, [key], time, tie, lambda w: {f"diff_{col}": F.col(col) - F.lag(col, 1).over(w)}, back=1, hot_rows=hot_rows
    )
