"""Exact metrics as aggregates (K1-K7, V4)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scalars import clip_probability, decision
from foldwright.plans.buckets import ROWS_PER_BUCKET, order_buckets
from foldwright.plans.hot import attach
from foldwright.plans.ranks import prefix_sums
from foldwright.session import stage

Aggregate = Callable[[Column, Column], Column]


def _scored(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())


def auc(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Area under the ROC curve, ties counted half; null if only one class occurs.

    One row per ``by`` value with ``auc``, ``n_pos``, ``n_neg``. Rows collapse to
    one per distinct score, written once, before anything is ordered: the scores
    may be costly to derive.
    """
    rows = df.select(*by, score, F.col(label).cast("long").alias("__fw_y"))
    counts = rows.groupBy(*by, score).agg(
        F.sum("__fw_y").alias("__fw_pos"), F.sum(1 - F.col("__fw_y")).alias("__fw_neg")
    )
    # a filter before would go down to the table, where it derives every score a second time
    counts = stage(counts, "score-counts").filter(F.col(score).isNotNull() & F.col("__fw_pos").isNotNull())
    below = prefix_sums(counts, score, {"__fw_below": F.col("__fw_neg")}, by, rows_per_bucket=rows_per_bucket)
    won = F.sum(F.col("__fw_pos") * (F.col("__fw_below") + F.col("__fw_neg") / 2.0))
    made = [
        F.try_divide(won, F.sum("__fw_pos").cast("double") * F.sum("__fw_neg")).alias("auc"),
        F.sum("__fw_pos").alias("n_pos"),
        F.sum("__fw_neg").alias("n_neg"),
    ]
    return below.groupBy(*by).agg(*made) if by else below.agg(*made)


def auc_error(areas: DataFrame) -> DataFrame:
    """Add the standard error of an area from the class sizes (Hanley-McNeil)."""
    a, p, n = F.col("auc"), F.col("n_pos"), F.col("n_neg")
    q1, q2 = a / (2 - a), 2 * a * a / (1 + a)
    spread = a * (1 - a) + (p - 1) * (q1 - a * a) + (n - 1) * (q2 - a * a)
    return areas.withColumn("auc_se", F.sqrt(F.try_divide(spread, p * n)))


def binary_report(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), cut: float = 0.5, pos_label: int = 1
) -> DataFrame:
    """accuracy, precision, recall and f1 of ``score > cut``."""
    y = (F.col(label) == F.lit(pos_label)).cast("int")
    guess = decision(F.col(score), cut)
    tp, fp = F.sum(y * guess), F.sum((1 - y) * guess)
    fn = F.sum(y * (1 - guess))
    rows = _scored(df, label, score)
    zero = F.lit(0.0)
    made = [
        F.avg((y == guess).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    ]
    return rows.groupBy(*by).agg(*made) if by else rows.agg(*made)


def class_report(df: DataFrame, label: str, guess: str) -> DataFrame:
    """Per class: support, precision, recall and f1, from the confusion counts."""
    cells = df.groupBy(F.col(label).alias("t"), F.col(guess).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("real"), F.lit(0).cast("long").alias("said"),
                 F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("g").alias("class"), F.lit(0).cast("long").alias("real"), F.col("n").alias("said"),
                 F.lit(0).cast("long").alias("hit")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("class").agg(F.sum("real").alias("support"), F.sum("said").alias("said"), F.sum("hit").alias("hit"))
    zero = F.lit(0.0)
    return sums.select(
        "class",
        "support",
        F.coalesce(F.try_divide("hit", "said"), zero).alias("precision"),
        F.coalesce(F.try_divide("hit", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hit"), F.col("said") + F.col("support")), zero).alias("f1"),
        "said",
        "hit",
    )


def averaged_report(df: DataFrame, label: str, guess: str) -> DataFrame:
    """precision, recall and f1 averaged three ways: ``micro``, ``macro``, ``weighted``."""
    per_class = class_report(df, label, guess)
    size = F.sum("support")
    made = [F.try_divide(F.sum("hit"), size).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        made += [
            F.try_divide(F.sum("hit"), size).alias(f"{m}_micro"),
            F.avg(m).alias(f"{m}_macro"),
            F.try_divide(F.sum(F.col(m) * F.col("support")), size).alias(f"{m}_weighted"),
        ]
    return per_class.agg(*made)


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def r2(y: Column, p: Column) -> Column:
    """``1 - SSE / SST``; null for a constant target."""
    return 1.0 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))


def log_loss(y: Column, p: Column) -> Column:
    q = clip_probability(p)
    return -F.avg(F.when(y == 1, F.ln(q)).otherwise(F.ln(1.0 - q)))


def accuracy(y: Column, p: Column) -> Column:
    return F.avg((y == decision(p)).cast("double"))


def f1(y: Column, p: Column) -> Column:
    g = decision(p)
    return F.coalesce(F.try_divide(2 * F.sum(y * g), F.sum(y) + F.sum(g)), F.lit(0.0))


#: Named metrics that are a plain aggregate, and whether larger is better.
AGGREGATES: dict[str, tuple[Aggregate, bool]] = {
    "rmse": (rmse, False),
    "mae": (mae, False),
    "mse": (mse, False),
    "r2": (r2, True),
    "logloss": (log_loss, False),
    "accuracy": (accuracy, True),
    "f1": (f1, True),
}
DEFAULT_METRICS = {"classification": ("auc", "accuracy", "f1"), "regression": ("rmse", "mae", "r2")}


def larger_is_better(metric: str) -> bool:
    return True if metric == "auc" else AGGREGATES[metric][1]


def score(
    df: DataFrame, label: str, guess: str, metric: str | Aggregate, by: Sequence[str] = ()
) -> DataFrame:
    """One ``score`` per ``by`` value. A callable maps (label, score) columns to an aggregate."""
    if metric == "auc":
        return auc(df, label, guess, by).select(*by, F.col("auc").alias("score"))
    make = metric if callable(metric) else AGGREGATES[metric][0]
    rows = _scored(df, label, guess)
    made = make(F.col(label), F.col(guess)).alias("score")
    return rows.groupBy(*by).agg(made) if by else rows.agg(made)


def regression_report(df: DataFrame, label: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(guess)
    made = [AGGREGATES[m][0](y, p).alias(m) for m in DEFAULT_METRICS["regression"]]
    rows = _scored(df, label, guess)
    return rows.groupBy(*by).agg(*made) if by else rows.agg(*made)


def brier(y: Column, p: Column) -> Column:
    """Mean squared distance of a row's class probabilities from its one-hot label."""
    squares = F.transform(p, lambda v, k: (v - (k == y).cast("double")) * (v - (k == y).cast("double")))
    return F.aggregate(squares, F.lit(0.0), lambda a, b: a + b) / F.size(p)


def fold_scores(
    df: DataFrame, label: str, guess: str, fold: str = "fold", metric: str | Aggregate | None = None,
    n_classes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scores per fold, and their mean and population standard deviation.

    Without a metric: AUC for up to two classes, negative MSE beyond. Arrays of
    class probabilities (labels 0, 1, ...) are compared with the one-hot label.
    """
    if metric is None and df.schema[guess].dataType.typeName() == "array":
        metric = lambda y, p: -F.avg(brier(y, p))
    if metric is None:
        if n_classes is None:
            n_classes = df.select(label).distinct().limit(3).count()
        metric = "auc" if n_classes <= 2 else (lambda y, p: -mse(y, p))
    per_fold = score(df, label, guess, metric, [fold])
    return per_fold, per_fold.agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))


# --------------------------------------------------------------- correlations


def average_ranks(df: DataFrame, col: str, name: str) -> DataFrame:
    """``(value, rank)`` per distinct value, equal values sharing their mean rank."""
    known = df.filter(F.col(col).isNotNull())
    limits = order_buckets(known, col)
    counts = known.groupBy(col).agg(F.count(F.lit(1)).alias("__fw_n"))
    below = prefix_sums(counts, col, {"__fw_below": F.col("__fw_n")}, limits=limits)
    return below.select(col, (F.col("__fw_below") + (F.col("__fw_n") + 1) / 2.0).alias(name))


def correlation_report(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and Spearman with two-sided p-values; needs three complete rows.

    ``reliable`` is r > 0.7 with p < 0.05. Ranks are joined to distinct (x, y)
    pairs, not to the rows.
    """
    known = df.select(x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = known.groupBy(x, y).agg(F.count(F.lit(1)).alias("__fw_w"))
    ranked = attach(attach(pairs, average_ranks(known, x, "__fw_rx"), [x]), average_ranks(known, y, "__fw_ry"), [y])
    centre = ranked.agg(
        F.try_divide(F.sum(F.col(x) * F.col("__fw_w")), F.sum("__fw_w")).alias("__fw_mx"),
        F.try_divide(F.sum(F.col(y) * F.col("__fw_w")), F.sum("__fw_w")).alias("__fw_my"),
        ((F.sum("__fw_w") + 1) / 2.0).alias("__fw_mr"),
    )
    moved = ranked.crossJoin(F.broadcast(centre))

    def corr(a: Column, b: Column) -> Column:
        w = F.col("__fw_w")
        return F.try_divide(F.sum(w * a * b), F.sqrt(F.sum(w * a * a)) * F.sqrt(F.sum(w * b * b)))

    one = moved.agg(
        corr(F.col(x) - F.col("__fw_mx"), F.col(y) - F.col("__fw_my")).alias("pearson_r"),
        corr(F.col("__fw_rx") - F.col("__fw_mr"), F.col("__fw_ry") - F.col("__fw_mr")).alias("spearman_r"),
        F.coalesce(F.sum("__fw_w"), F.lit(0)).alias("n"),
    ).first()
    if one["n"] < 3:
        raise ValueError("need at least 3 rows")
    r, s, n = one["pearson_r"], one["spearman_r"], one["n"]
    p, q = correlation_p(r, n), correlation_p(s, n)
    line = (r, p, s, q, n, bool(r is not None and r > 0.7 and p < 0.05))
    return df.sparkSession.createDataFrame(
        [line], "pearson_r double, pearson_p double, spearman_r double, spearman_p double, n long, reliable boolean"
    )


def correlation_p(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a correlation under Student's t with n - 2 degrees of freedom."""
    if r is None:
        return None
    if abs(r) >= 1.0:
        return 0.0
    if n <= 2:
        return 1.0
    df = n - 2
    t2 = r * r * df / (1.0 - r * r)
    if df > 1e7:
        # the normal limit with its first correction; the fraction's terms cancel to nothing there
        t = math.sqrt(t2)
        return math.erfc(t * (1.0 - (t2 + 1.0) / (4.0 * df)) / math.sqrt(2.0)) if t2 < df else 0.0
    return _beta_share(df / 2.0, 0.5, df / (df + t2), t2 / (df + t2))


def _beta_share(a: float, b: float, x: float, y: float) -> float:
    """Regularised incomplete beta function by its continued fraction (Lentz's method, run to convergence).

    ``y`` is ``1 - x``, given apart because either may be too small to tell from the other.
    """
    if x <= 0.0 or y <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_share(b, a, y, x)
    log = lambda p, q: math.log1p(-q) if q < 0.5 else math.log(p)
    front = math.exp(_log_beta_ratio(a, b) + a * log(x, y) + b * log(y, x)) / a
    # modified Lentz: convergents of 1 / (1 + t1 / (1 + t2 / ...)), two terms a step
    tiny = 1e-300
    held = lambda v: v if abs(v) > tiny else tiny
    c, d = 1.0, 1.0 / held(1.0 - (a + b) * x / (a + 1.0))
    value, m = d, 0
    while True:
        m += 1
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d, c = 1.0 / held(1.0 + even * d), held(1.0 + even / c)
        value *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d, c = 1.0 / held(1.0 + odd * d), held(1.0 + odd / c)
        value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            return front * value


def _log_beta_ratio(a: float, b: float) -> float:
    """``log(gamma(a + b) / (gamma(a) gamma(b)))`` without the difference of two huge logarithms."""
    large, small = max(a, b), min(a, b)
    if large < 1e4:
        return math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    # Stirling's series for gamma(large + small) / gamma(large)
    series = lambda z: 1 / (12 * z) - 1 / (360 * z**3)
    total = large + small
    ratio = small * math.log(total) + (large - 0.5) * math.log1p(small / large) - small + series(total) - series(large)
    return ratio - math.lgamma(small)
