"""Category encoders: fit gives a small state table, applying it is a join.

State is long, ``(column, category, ...)``, with one ``__all__`` row per fit
that carries the totals, so any number of columns is fitted in one aggregate.
Out-of-fold values need no refit per fold: what the other folds know about a
category is its total minus the row's own fold.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.functions import names
from foldwright.functions.names import as_list, require
from foldwright.functions.scalars import normal_from_hash
from foldwright.operators.splits import FOLD
from foldwright.plans.hot import attach
from foldwright.plans.ranks import ordered_index
from foldwright.plans.size import is_small
from foldwright.session import stage

ALL = "__all__"
_ROWS = "__fw_n"
_CATEGORY = "__fw_category"


def _pairs(cols: Sequence[str], with_all: bool = True) -> Column:
    """The row's (column, category) pairs, to be exploded into one aggregate."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols]
    if with_all:
        pairs.append(F.struct(F.lit(ALL).alias("column"), F.lit("").alias("category")))
    return F.explode(F.array(*pairs)).alias("pair")


def _pair_counts(df: DataFrame, cols: Sequence[str], target: str, extra: Sequence[str] = ()) -> DataFrame:
    slim = df.select(*extra, F.col(target).cast("double").alias("__fw_y"), _pairs(cols))
    slim = slim.select(*extra, "pair.column", "pair.category", "__fw_y").filter(F.col("category").isNotNull())
    return slim.groupBy("column", "category", *extra).agg(
        F.sum("__fw_y").alias("total"), F.count("__fw_y").alias("n"), F.count(F.lit(1)).alias(_ROWS)
    )


def _join_column(
    df: DataFrame, state: DataFrame, col: str, extra: Sequence[str] = (), small: bool | None = None
) -> DataFrame:
    """Attach one column's slice of a long state table."""
    mine = state.filter(F.col("column") == col).drop("column").withColumnRenamed("category", _CATEGORY)
    sizes = mine.select(_CATEGORY, *extra, _ROWS) if _ROWS in mine.columns else None
    if sizes is not None:
        mine = mine.drop(_ROWS)
    keyed = df.withColumn(_CATEGORY, F.col(col).cast("string"))
    return attach(keyed, mine, [_CATEGORY, *extra], sizes=sizes, small=small).drop(_CATEGORY)


def _present(df: DataFrame, cols: Sequence[str], fitted: Sequence[str], handle_unknown: str) -> list[str]:
    usable = []
    for col in cols:
        problem = (
            f"Column '{col}' not found" if col not in df.columns
            else f"Column '{col}' was not fitted" if col not in fitted
            else None
        )
        if problem is None:
            usable.append(col)
        elif handle_unknown == "error":
            raise ValueError(problem)
        else:
            warnings.warn(f"{problem}; skipping it")
    return usable


# ------------------------------------------------------------ target encoding


def fit_target(
    df: DataFrame, cols: str | Sequence[str], target: str, smoothing: float = 10.0, min_samples_leaf: int = 1
) -> DataFrame:
    """State ``(column, category, n, value)``; the ``__all__`` row holds the global mean.

    ``value = (n * mean + smoothing * global) / (n + smoothing)``. Fitting is
    eager: one aggregate, written to the shared folder for the joins to read.
    """
    cols = as_list(cols)
    require(df, [*cols, target])
    counts = stage(_pair_counts(df, cols, target), "target-counts", "column")
    overall = _all_row(counts).select(F.try_divide("total", F.col("n"))).first()[0]
    prior = F.lit(overall).cast("double")
    value = (F.coalesce("total", F.lit(0.0)) + smoothing * prior) / F.nullif(
        F.col("n") + F.lit(float(smoothing)), F.lit(0.0)
    )
    enough = (F.col("n") >= min_samples_leaf) & (F.col("n") > 0)
    value = F.when((F.col("column") == ALL) | ~enough, prior).otherwise(value)
    return counts.select("column", "category", "n", value.alias("value"))


def _all_row(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("column") == ALL)


def apply_target(
    df: DataFrame,
    state: DataFrame,
    cols: str | Sequence[str],
    keep: Sequence[str] | None = None,
    handle_unknown: str = "value",
    fitted: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``{c}_target_enc``; unseen and null categories get the global mean.

    ``keep`` limits the other columns returned. ``handle_unknown='error'``
    raises for columns that are missing or were not fitted.
    """
    cols = as_list(cols)
    cols = _present(df, cols, cols if fitted is None else fitted, handle_unknown)
    prior = F.lit(_all_row(state).select("value").first()[0]).cast("double")
    out, small = df, is_small(df)
    for col in cols:
        slice_ = state.select("column", "category", F.col("value").alias("__fw_v"))
        out = _join_column(out, slice_, col, small=small)
        out = out.withColumn(names.TARGET_ENC.format(col=col), F.coalesce("__fw_v", prior)).drop("__fw_v")
    return out if keep is None else out.select(*keep, *[names.TARGET_ENC.format(col=c) for c in cols])


def _fold_counts(df: DataFrame, cols: Sequence[str], target: str, fold: str) -> DataFrame:
    """``(column, category, fold, total, n)``, the only pass over the rows that fitting needs."""
    return stage(_pair_counts(df, cols, target, [fold]), "fold-counts", "column")


def _fold_totals(counts: DataFrame, fold: str) -> dict[object, tuple[float, int]]:
    """Target sum and count per fold: k numbers, used as literals."""
    return {r[0]: (r[1] or 0.0, r[2]) for r in _all_row(counts).select(fold, "total", "n").collect()}


def _priors(totals: dict[object, tuple[float, int]], prior: str) -> dict[object, float | None]:
    """Per fold the mean of the other folds (or of all rows)."""
    if prior not in ("fold", "all"):
        raise ValueError(f"prior must be 'fold' or 'all', not {prior!r}")
    t, m = sum(v[0] for v in totals.values()), sum(v[1] for v in totals.values())
    found = {}
    for fold, (own_t, own_m) in totals.items():
        rest_t, rest_m = (t - own_t, m - own_m) if prior == "fold" else (t, m)
        found[fold] = rest_t / rest_m if rest_m else None
    return found


def _per_fold(fold: str, values: dict[object, float | None]) -> Column:
    out = F.lit(None).cast("double")
    for k, v in values.items():
        out = F.when(F.col(fold) == F.lit(k), F.lit(v).cast("double")).otherwise(out)
    return out


def _rest_of_folds(counts: DataFrame) -> DataFrame:
    """Add what the other folds know of a category; a category has at most k rows here."""
    per_category = Window.partitionBy("column", "category")
    total = F.coalesce("total", F.lit(0.0))
    return counts.filter(F.col("column") != ALL).select(
        "*",
        (F.sum(total).over(per_category) - total).alias("rest_t"),
        (F.sum("n").over(per_category) - F.col("n")).alias("rest_n"),
    )


def oof_target_state(
    df: DataFrame,
    cols: Sequence[str],
    target: str,
    fold: str = FOLD,
    smoothing: float = 10.0,
    min_samples_leaf: int = 1,
    prior: str = "fold",
) -> tuple[DataFrame, Column]:
    """``(column, category, fold) -> value`` and the prior of a row's fold.

    ``prior='fold'`` uses the mean of the training folds; ``'all'`` uses the
    mean of every row, which leaks the held-out targets a little.
    """
    counts = _fold_counts(df, cols, target, fold)
    base = _per_fold(fold, _priors(_fold_totals(counts, fold), prior))
    enough = (F.col("rest_n") >= min_samples_leaf) & (F.col("rest_n") > 0)
    smooth = (F.col("rest_t") + smoothing * base) / F.nullif(F.col("rest_n") + F.lit(float(smoothing)), F.lit(0.0))
    value = F.when(enough, smooth).otherwise(base)
    return _rest_of_folds(counts).select("column", "category", fold, _ROWS, value.alias("__fw_v")), base


def oof_target_encode(
    df: DataFrame,
    cols: str | Sequence[str],
    target: str,
    fold: str = FOLD,
    smoothing: float = 10.0,
    min_samples_leaf: int = 1,
    prior: str = "fold",
    noise: float = 0.0,
    seed: int = 42,
    id_cols: str | Sequence[str] = (),
    replace: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``{c}_target_enc`` from the other folds only (``fold`` must exist).

    Noise is drawn from the row id, so a retry gives the same values.
    ``replace`` overwrites the category column instead of adding one.
    """
    cols = as_list(cols)
    require(df, [*cols, target, fold])
    state, base = oof_target_state(df, cols, target, fold, smoothing, min_samples_leaf, prior)
    out, made, small = df, [], is_small(df)
    for col in cols:
        out = _join_column(out, state, col, [fold], small)
        value = F.coalesce("__fw_v", base)
        if noise > 0:
            value = value + F.lit(noise) * normal_from_hash(seed, col, *[F.col(c) for c in as_list(id_cols)])
        name = col if replace else names.TARGET_ENC.format(col=col)
        out = out.withColumn(f"__fw_{name}", value).drop("__fw_v")
        made.append(name)
    others = [c for c in df.columns if c not in made]
    final = out.select(*others, *[F.col(f"__fw_{n}").alias(n) for n in made])
    return final if keep is None else final.select(*keep, *made)


def fit_fold_average(
    df: DataFrame, col: str, target: str, fold: str = FOLD, smoothing: float = 10.0
) -> tuple[DataFrame, float | None]:
    """``category -> value``: the mean of the k encoders that each left one fold out.

    Also returns the mean prior, for unseen categories. Folds in which the
    category does not occur all use its full total, so their sum has a closed
    form and one row per category is enough.
    """
    require(df, [col, target, fold])
    s = F.lit(float(smoothing))
    counts = _fold_counts(df, [col], target, fold)
    priors = _priors(_fold_totals(counts, fold), "fold")
    k, all_g = len(priors), sum(v or 0.0 for v in priors.values())
    base = _per_fold(fold, priors)
    left_out = F.when(
        F.col("rest_n") > 0, F.try_divide(F.col("rest_t") + s * base, F.col("rest_n") + s)
    ).otherwise(base)
    table = _rest_of_folds(counts).groupBy("category").agg(
        F.sum(left_out).alias("present"),
        F.count(F.lit(1)).alias("n_present"),
        F.sum(base).alias("present_g"),
        F.sum(F.coalesce("total", F.lit(0.0))).alias("all_t"),
        F.sum("n").alias("all_n"),
    )
    absent = F.try_divide(
        (F.lit(k) - F.col("n_present")) * F.col("all_t") + s * (F.lit(all_g) - F.col("present_g")), F.col("all_n") + s
    )
    value = (F.col("present") + F.coalesce(absent, F.lit(0.0))) / F.lit(float(k))
    return table.select("category", value.alias("__fw_v")), all_g / k if k else None


def apply_fold_average(df: DataFrame, state: DataFrame, prior: float | None, col: str) -> DataFrame:
    """Add ``oof_{c}`` for rows outside the training table; unseen gets the mean prior."""
    keyed = df.withColumn(_CATEGORY, F.col(col).cast("string"))
    out = attach(keyed, state.withColumnRenamed("category", _CATEGORY), [_CATEGORY])
    value = F.coalesce("__fw_v", F.lit(prior).cast("double"))
    return out.withColumn(f"oof_{col}", value).drop(_CATEGORY, "__fw_v")


def group_target(
    df: DataFrame,
    keys: str | Sequence[str],
    target: str,
    smoothing: float = 10.0,
    fold: str | None = None,
) -> DataFrame:
    """Add ``{t}_encoded_by_{keys}``: smoothed target mean of the key combination.

    In-sample by default, so it leaks the row's own target; give ``fold`` for
    the out-of-fold form.
    """
    keys = as_list(keys)
    require(df, [*keys, target])
    name = names.GROUP_TARGET.format(target=target, group=names.group_name(keys))
    known = df
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    y = F.col(target).cast("double")
    if fold is None:
        overall = df.agg(F.avg(y).alias("__fw_g"))
        table = known.groupBy(*keys).agg(
            F.sum(y).alias("__fw_t"), F.count(y).alias("__fw_m"), F.count(F.lit(1)).alias(_ROWS)
        )
        table = table.crossJoin(F.broadcast(overall))
        gain = F.coalesce("__fw_t", F.lit(0.0)) + smoothing * F.col("__fw_g")
        value = F.try_divide(gain, F.col("__fw_m") + F.lit(float(smoothing)))
        out = attach(
            df.crossJoin(F.broadcast(overall)),
            table.select(*keys, value.alias("__fw_v")),
            keys,
            sizes=table.select(*keys, _ROWS),
        )
        return out.withColumn(name, F.coalesce("__fw_v", "__fw_g")).drop("__fw_v", "__fw_g")
    combo = F.when(
        F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull(),
        F.to_json(F.array(*[F.col(k).cast("string") for k in keys])),
    )
    coded = oof_target_encode(df.withColumn("__fw_combo", combo), "__fw_combo", target, fold, smoothing)
    return coded.withColumnRenamed(names.TARGET_ENC.format(col="__fw_combo"), name).drop("__fw_combo")


# ------------------------------------------------------- counts, ranks, weight


def fit_counts(
    df: DataFrame, cols: str | Sequence[str], normalize: bool = False, min_count: int | None = None
) -> DataFrame:
    """State ``(column, category, value)``: counts, or shares of the non-null rows."""
    cols = as_list(cols)
    require(df, cols)
    pairs = df.select(_pairs(cols, with_all=False)).select("pair.*").filter(F.col("category").isNotNull())
    counts = pairs.groupBy("column", "category").agg(F.count(F.lit(1)).alias("value"))
    counts = stage(counts, "category-counts", "column")
    if normalize:
        whole = counts.groupBy("column").agg(F.sum("value").alias("all_n"))
        return counts.join(F.broadcast(whole), "column").select(
            "column", "category", (F.col("value") / F.col("all_n")).alias("value")
        )
    return counts.filter(F.col("value") >= min_count) if min_count is not None else counts


def apply_counts(
    df: DataFrame, state: DataFrame, cols: str | Sequence[str], handle_unknown: str = "value"
) -> DataFrame:
    """Add ``{c}_count_enc``: null gives 0; unseen the smallest kept count, 0, or an error."""
    if handle_unknown not in ("value", "zero", "error"):
        raise ValueError(f"handle_unknown must be value, zero or error, not {handle_unknown!r}")
    out, small = df, is_small(df)
    for col in [c for c in as_list(cols) if c in df.columns]:
        slice_ = state.select("column", "category", F.col("value").alias("__fw_v"))
        if handle_unknown == "error":
            known = slice_.filter(F.col("column") == col).select("category")
            seen = df.select(F.col(col).cast("string").alias("category")).filter(F.col("category").isNotNull())
            stray = seen.distinct().join(known, "category", "left_anti").limit(1).collect()
            if stray:
                raise ValueError(f"Unknown category: {stray[0][0]}")
        out = _join_column(out, slice_, col, small=small)
        default = F.lit(0)
        if handle_unknown == "value":
            lowest = state.filter(F.col("column") == col).agg(F.min("value")).first()[0]
            default = F.lit(lowest or 0)
        value = F.when(F.col(col).isNull(), F.lit(0)).otherwise(F.coalesce(F.col("__fw_v"), default))
        out = out.withColumn(names.COUNT_ENC.format(col=col), value).drop("__fw_v")
    return out


def _ranked(counts: DataFrame, ascending: bool) -> DataFrame:
    """Add ``rank`` to ``(category, n)``: by count, ties by category."""
    at = ordered_index(counts, "n", "category", descending=not ascending, name="__fw_at")
    return at.withColumn("rank", F.col("__fw_at") + 1).drop("__fw_at")


def frequency_ranks(df: DataFrame, col: str, ascending: bool = False) -> DataFrame:
    """``(category, n, rank)``: 1 is the most (or least) frequent, ties by category."""
    known = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("category"))
    counts = stage(known.groupBy("category").agg(F.count(F.lit(1)).alias("n")), "category-counts")
    return _ranked(counts, ascending)


def fit_frequency(df: DataFrame, cols: str | Sequence[str], ascending: bool = False) -> DataFrame:
    """State ``(column, category, value)`` with the rank as value; one pass over the rows."""
    counts = fit_counts(df, cols)
    out = None
    for c in as_list(cols):
        mine = counts.filter(F.col("column") == c).select("category", F.col("value").alias("n"))
        part = _ranked(mine, ascending).select(F.lit(c).alias("column"), "category", F.col("rank").alias("value"))
        out = part if out is None else out.unionByName(part)
    return stage(out, "frequency-ranks", "column")


def apply_frequency(df: DataFrame, state: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Add ``{c}_freq_enc`` as double; unseen and null get the largest rank plus one."""
    out, small = df, is_small(df)
    for col in [c for c in as_list(cols) if c in df.columns]:
        top = state.filter(F.col("column") == col).agg(F.max("value")).first()[0] or 0
        out = _join_column(out, state.select("column", "category", F.col("value").alias("__fw_v")), col, small=small)
        value = F.coalesce(F.col("__fw_v"), F.lit(top + 1)).cast("double")
        out = out.withColumn(names.FREQ_ENC.format(col=col), value).drop("__fw_v")
    return out


def oof_weight_of_evidence(
    df: DataFrame, cols: str | Sequence[str], target: str, fold: str = FOLD, alpha: float = 0.5
) -> DataFrame:
    """Add ``{c}_woe_enc``: ``ln(((pos+a)/(P+a*k)) / ((neg+a)/(N+a*k)))`` from the other folds.

    ``k`` is the number of categories; unseen and null categories get 0.
    """
    cols = as_list(cols)
    require(df, [*cols, target, fold])
    counts = _fold_counts(df, cols, target, fold)
    totals = _fold_totals(counts, fold)
    t, m = sum(v[0] for v in totals.values()), sum(v[1] for v in totals.values())
    positives = _per_fold(fold, {f: t - own for f, (own, _) in totals.items()})
    negatives = _per_fold(fold, {f: (m - t) - (n - own) for f, (own, n) in totals.items()})
    kinds = counts.groupBy("column").agg(F.count_distinct("category").alias("k"))
    width = F.lit(0)
    for r in kinds.collect():
        width = F.when(F.col("column") == r["column"], F.lit(r["k"])).otherwise(width)
    a = F.lit(float(alpha))
    pos, neg = F.col("rest_t"), F.col("rest_n") - F.col("rest_t")
    woe = F.ln(((pos + a) / (positives + a * width)) / ((neg + a) / (negatives + a * width)))
    value = F.when(F.col("rest_n") > 0, woe).otherwise(0.0)
    state = _rest_of_folds(counts).select("column", "category", fold, _ROWS, value.alias("__fw_v"))
    out, small = df, is_small(df)
    for col in cols:
        out = _join_column(out, state, col, [fold], small)
        out = out.withColumn(names.WOE_ENC.format(col=col), F.coalesce("__fw_v", F.lit(0.0))).drop("__fw_v")
    return out


def with_noise(df: DataFrame, col: str, sd: float, id_cols: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Add Gaussian noise to a column, repeatable per row id."""
    ids = [F.col(c) for c in as_list(id_cols)]
    return df.withColumn(col, F.col(col) + F.lit(float(sd)) * normal_from_hash(seed, col, *ids))
