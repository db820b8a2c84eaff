"""Group aggregates brought back to the rows."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions import names
from foldwright.functions.names import as_list, require
from foldwright.functions.scalars import numeric_columns, ratio
from foldwright.plans.hot import attach
from foldwright.plans.quantiles import group_quantiles
from foldwright.plans.size import is_small
from foldwright.session import stage

DEFAULT_STATS = ("mean", "std", "min", "max", "median", "count", "nunique")
PREFIX_STATS = ("mean", "std", "min", "max", "count", "median", "skew")
_SIZE = "__fw_n"


def bias_corrected_skew(col: str) -> Column:
    """Sample skewness; null below three values or without spread."""
    n = F.count(col).cast("double")
    return F.when(
        (n >= 3) & (F.stddev_pop(col) > 0), F.skewness(col) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    )


# every one of these has a partial (map-side) form
_ALGEBRAIC: dict[str, Callable[[str], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "count": F.count,
    "nunique": F.count_distinct,
    "skew": bias_corrected_skew,
}
_APPROXIMATE: dict[str, Callable[[str], Column]] = {
    "median": lambda c: F.percentile_approx(c, 0.5, 10_000),
    "nunique": F.approx_count_distinct,
}


def group_stats(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Sequence[str],
    stats: Sequence[str],
    name: Callable[[str, str], str],
    approximate: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per (non-null) key with every statistic of every column.

    Everything but the exact median is one aggregate. Medians go through
    ``group_quantiles`` so that a hot key never has to fit in one buffer.
    """
    keys = as_list(keys)
    known = df
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    unknown = [s for s in stats if s not in _ALGEBRAIC and s != "median"]
    if unknown:
        raise ValueError(f"Unknown aggregation: {unknown[0]}")
    made = [F.count(F.lit(1)).alias(_SIZE)]
    for col in cols:
        for stat in stats:
            make = (approximate and _APPROXIMATE.get(stat)) or _ALGEBRAIC.get(stat)
            if make is not None:
                made.append(make(col).alias(name(col, stat)))
    table = known.groupBy(*keys).agg(*made)
    if hot_rows is not None or not is_small(df):
        # read by the hot-key check and on both sides of the join: aggregate once
        table = stage(table, "group-stats")
    if "median" in stats and not approximate:
        medians = group_quantiles(known, keys, cols, [0.5], hot_rows, table.select(*keys, _SIZE))
        medians = medians.select(*keys, *[F.element_at(c, 1).alias(name(c, "median")) for c in cols])
        table = table.join(medians, keys, "left")
    return table.select(*keys, _SIZE, *[name(c, s) for c in cols for s in stats])


def _back_to_rows(df: DataFrame, table: DataFrame, keys: Sequence[str], hot_rows: int | None) -> DataFrame:
    sizes = table.select(*keys, _SIZE)
    return attach(df, table.drop(_SIZE), keys, sizes=sizes, hot_rows=hot_rows)


def group_features(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Sequence[str] | None = None,
    stats: Sequence[str] | None = None,
    diff: bool = True,
    ratios: bool = True,
    hierarchical: bool = False,
    prefix: str | None = None,
    suffix: str | None = None,
    approximate: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``{v}_{stat}_by_{keys}`` plus differences and ratios to mean and median.

    ``hierarchical`` also adds the mean for every strict prefix of the keys.
    """
    keys = as_list(keys)
    require(df, keys)
    cols = numeric_columns(df, keys) if cols is None else [c for c in cols if c in df.columns]
    if not cols:
        warnings.warn("nothing to aggregate: none of the columns is numeric")
        return df
    stats = list(DEFAULT_STATS if stats is None else stats)
    by = names.group_name(keys, prefix, suffix)

    def stat_name(col: str, stat: str) -> str:
        return names.GROUP_STAT.format(col=col, stat=stat, group=by)

    out = _back_to_rows(df, group_stats(df, keys, cols, stats, stat_name, approximate, hot_rows), keys, hot_rows)
    derived: dict[str, Column] = {}
    for col in cols:
        # median companions come with the mean, as users of the names expect
        for stat in ("mean", "median") if "mean" in stats else ():
            if stat not in stats:
                continue
            base = F.col(stat_name(col, stat))
            if diff:
                derived[names.GROUP_DIFF.format(col=col, stat=stat, group=by)] = F.col(col) - base
            if ratios:
                derived[names.GROUP_RATIO.format(col=col, stat=stat, group=by)] = ratio(F.col(col), base)
    out = out.withColumns(derived) if derived else out
    if hierarchical:
        for length in range(1, len(keys)):
            part = keys[:length]
            part_by = names.group_name(part, prefix, suffix)
            table = group_stats(
                df, part, cols, ["mean"], lambda c, s: names.GROUP_STAT.format(col=c, stat=s, group=part_by)
            )
            out = _back_to_rows(out, table, part, hot_rows)
    return out


def basic_group_features(df: DataFrame, keys: str | Sequence[str], cols: Sequence[str], **options) -> DataFrame:
    """The short form: mean, std, min, max and no median columns."""
    return group_features(df, keys, cols, ["mean", "std", "min", "max"], **options)


def mean_std_features(df: DataFrame, keys: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The shortest form: ``{v}_mean`` and ``{v}_std`` only."""
    keys = as_list(keys)
    table = group_stats(df, keys, cols, ["mean", "std"], lambda c, s: f"{c}_{s}")
    return _back_to_rows(df, table, keys, None)


def prefixed_group_features(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: str | Sequence[str],
    stats: Sequence[str] | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """The prefix-first names: ``{g}_{v}_{stat}``, ``{v}_to_{g}_mean_ratio``, ``{v}_minus_{g}_mean``."""
    keys = as_list(keys)
    require(df, keys)
    cols = [c for c in as_list(cols) if c in numeric_columns(df)]
    stats = list(PREFIX_STATS if stats is None else stats)
    group = prefix or names.group_name(keys)
    table = group_stats(
        df, keys, cols, stats, lambda c, s: names.PREFIX_STAT.format(group=group, col=c, stat=s)
    )
    out = _back_to_rows(df, table, keys, None)
    derived = {}
    for col in cols if "mean" in stats else ():
        mean = F.col(names.PREFIX_STAT.format(group=group, col=col, stat="mean"))
        derived[names.PREFIX_RATIO.format(col=col, group=group)] = ratio(F.col(col), mean)
        derived[names.PREFIX_DIFF.format(col=col, group=group)] = F.col(col) - mean
    return out.withColumns(derived) if derived else out


def group_mode(df: DataFrame, keys: Sequence[str], col: str, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per key, the smallest on ties.

    Counting first keeps a hot key's values spread over many tasks.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias(_SIZE))
    best = counts.groupBy(*keys, _SIZE).agg(F.min(col).alias(col))
    return best.groupBy(*keys).agg(F.max_by(col, _SIZE).alias(name or f"{col}_mode"))


def majority_class(df: DataFrame, group: str, label: str) -> DataFrame:
    """Per group: rows, number of classes and majority class (the lowest on ties)."""
    counts = df.filter(F.col(group).isNotNull()).groupBy(group, label).agg(F.count(F.lit(1)).alias(_SIZE))
    # labels of any type: most rows first, then the lowest label, null after all others
    order = F.struct((-F.col(_SIZE)).alias("n"), F.col(label).isNull().alias("none"), F.col(label).alias("label"))
    return counts.groupBy(group).agg(
        F.sum(_SIZE).alias("n_rows"), F.count(label).alias("n_classes"), F.min(order)["label"].alias("majority")
    )


def class_counts(df: DataFrame, group: str, label: str) -> DataFrame:
    return df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str, normalize: bool = False, min_count: int | None = None) -> DataFrame:
    """Counts (or shares of the non-null rows) per value; ``min_count`` filters counts only."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        whole = counts.agg(F.sum("n").alias("__fw_all"))
        return counts.crossJoin(F.broadcast(whole)).select(
            col, (F.col("n") / F.col("__fw_all")).alias("share")
        )
    return counts.filter(F.col("n") >= min_count) if min_count is not None else counts


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def centroids(df: DataFrame, label: str, cols: Sequence[str] | None = None, vector: str | None = None) -> DataFrame:
    """Class means of columns, or of an array column (long form: class, position, mean)."""
    if vector is None:
        return df.groupBy(label).agg(*[F.avg(c).alias(c) for c in cols])
    elements = df.select(label, F.posexplode(vector).alias("position", "x"))
    return elements.groupBy(label, "position").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def centroid_vectors(df: DataFrame, label: str, vector: str) -> DataFrame:
    """One array per class; the array is as long as the vectors, so it stays small."""
    means = centroids(df, label, vector=vector)
    packed = means.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("position", "mean"))).alias("m"))
    return packed.select(label, F.transform("m", lambda s: s["mean"]).alias("centroid"))
