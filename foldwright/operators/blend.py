"""Blending predictions, searching weights, diversity.

Predictions are a wide table: an id, the label and one column per model.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.functions import vectors
from foldwright.functions.scalars import decision
from foldwright.operators import metrics


def blend_column(models: Sequence[str], weights: dict[str, float] | None = None, method: str = "weighted") -> Column:
    cols = [F.col(m) for m in models]
    if method == "mean":
        return vectors.row_mean(cols)
    if method == "median":
        return vectors.row_median(cols)
    if method == "geometric":
        return vectors.row_geometric_mean(cols)
    if method == "weighted":
        return vectors.weighted_mean(cols, [1.0 if weights is None else weights.get(m, 0.0) for m in models])
    raise ValueError(f"no such way to blend: {method}")


def blend(
    df: DataFrame,
    models: Sequence[str],
    weights: dict[str, float] | None = None,
    method: str = "weighted",
    name: str = "blend",
) -> DataFrame:
    """Add the blended prediction: one projection, no shuffle."""
    return df.withColumn(name, blend_column(models, weights, method))


# -------------------------------------------------------------- weight search


def score_weights(
    df: DataFrame, label: str, models: Sequence[str], candidates: Sequence[Sequence[float]], metric: str = "auc"
) -> list[float]:
    """The metric of every candidate weight vector, in one job.

    Metrics that are plain aggregates need no shuffle at all: each candidate is
    one more aggregate column. AUC adds one row per candidate and distinct score.
    """
    cols = [F.col(m) for m in models]
    blends = [vectors.weighted_mean(cols, w) for w in candidates]
    if metric != "auc":
        make = metrics.AGGREGATES[metric][0]
        row = df.agg(*[make(F.col(label), b).alias(f"c{i}") for i, b in enumerate(blends)]).first()
        return list(row)
    long = df.select(label, F.posexplode(F.array(*blends)).alias("candidate", "blend"))
    rows = metrics.auc(long, label, "blend", ["candidate"]).select("candidate", "auc").collect()
    found = {r["candidate"]: r["auc"] for r in rows}
    return [found[i] for i in range(len(candidates))]


#: Ranges of equal width per unit of score in which bounds of an AUC are counted.
AUC_RANGES = 65_536


def auc_bounds(
    df: DataFrame, label: str, models: Sequence[str], candidates: Sequence[Sequence[float]], ranges: int = AUC_RANGES
) -> list[tuple[float, float]]:
    """Limits between which each candidate's AUC lies.

    Positives and negatives are counted by score range, map-side, so what moves
    does not grow with the rows; pairs inside a range may go either way.
    """
    blends = [vectors.weighted_mean([F.col(m) for m in models], w) for w in candidates]
    y = F.col(label).cast("long")
    long = df.filter(F.col(label).isNotNull()).select(y.alias("y"), F.posexplode(F.array(*blends)).alias("candidate", "blend"))
    cells = long.filter(F.col("blend").isNotNull()).groupBy("candidate", F.floor(F.col("blend") * ranges).alias("range"))
    cells = cells.agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    before = Window.partitionBy("candidate").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    made = [F.try_divide(F.sum(F.col("pos") * n), pairs) for n in (F.col("below"), F.col("below") + F.col("neg"))]
    found = {r["candidate"]: (r["low"], r["high"]) for r in cells.groupBy("candidate").agg(made[0].alias("low"), made[1].alias("high")).collect()}
    return [found[i] for i in range(len(candidates))]


def best_weights(
    df: DataFrame, label: str, models: Sequence[str], candidates: Sequence[Sequence[float]], metric: str, above: float
) -> tuple[int, float] | None:
    """The first of the best candidates and its exact score, signed so that larger is better; None if none beats ``above``.

    For AUC only candidates whose bounds allow them to win are ranked exactly.
    """
    left = list(range(len(candidates)))
    if metric == "auc":
        bounds = auc_bounds(df, label, models, candidates)
        if any(low is None for low, _ in bounds):
            raise ValueError("the area under the curve needs both classes")
        # a little room, as bounds are sums of doubles
        least = max(above, max(low for low, _ in bounds)) - 1e-12
        left = [i for i in left if bounds[i][1] >= least]
        if not left:
            return None
    sign = 1.0 if metrics.larger_is_better(metric) else -1.0
    scores = [sign * s for s in score_weights(df, label, models, [candidates[i] for i in left], metric)]
    top = int(np.argmax(scores))
    return (left[top], scores[top]) if scores[top] > above else None


def _normalise(w: np.ndarray) -> np.ndarray | None:
    w = np.maximum(w, 0.0)
    return w / w.sum() if w.sum() > 0 else None


def _neighbours(weights: np.ndarray, step: float) -> list[np.ndarray]:
    moved = []
    for i in range(len(weights)):
        for direction in (-1.0, 1.0):
            w = weights.copy()
            w[i] += direction * step
            w = _normalise(w)
            if w is not None and not np.allclose(w, weights):
                moved.append(w)
    return moved


def hill_climb(
    df: DataFrame,
    label: str,
    models: Sequence[str],
    metric: str = "auc",
    max_iterations: int = 1000,
    step: float = 0.01,
    patience: int = 50,
    batch: int = 16,
    seed: int = 42,
) -> tuple[dict[str, float], float]:
    """Random coordinate moves from equal weights; a batch of proposals per job.

    ``max_iterations`` and ``patience`` count proposals. The direction of the
    metric is known, so the best of a batch is the one to keep.
    """
    sign = 1.0 if metrics.larger_is_better(metric) else -1.0
    rng = np.random.default_rng(seed)
    slim = df.select(label, *models).persist()
    try:
        weights = np.full(len(models), 1.0 / len(models))
        best = sign * score_weights(slim, label, models, [weights.tolist()], metric)[0]
        tried = idle = 0
        while tried < max_iterations and idle < patience:
            proposals = []
            for _ in range(min(batch, max_iterations - tried)):
                w = weights.copy()
                w[rng.integers(len(models))] += step * rng.choice([-1.0, 1.0])
                w = _normalise(w)
                if w is not None:
                    proposals.append(w)
            if not proposals:
                break
            found = best_weights(slim, label, models, [w.tolist() for w in proposals], metric, best)
            tried += len(proposals)
            if found is not None:
                weights, best, idle = proposals[found[0]], found[1], 0
            else:
                idle += len(proposals)
    finally:
        slim.unpersist()
    return dict(zip(models, weights.tolist())), sign * best


def sweep_weights(
    df: DataFrame,
    label: str,
    models: Sequence[str],
    metric: str = "auc",
    initial: dict[str, float] | None = None,
    step: float = 0.01,
    smallest_step: float = 1e-4,
    max_sweeps: int = 100,
    precision: int = 4,
) -> tuple[dict[str, float], float]:
    """Deterministic search: both directions of every weight per sweep, best move kept.

    Without improvement the step is halved, until it is below ``smallest_step``.
    """
    sign = 1.0 if metrics.larger_is_better(metric) else -1.0
    start = np.array([1.0 / len(models) if initial is None else initial.get(m, 1.0 / len(models)) for m in models])
    weights = _normalise(start)
    if weights is None:
        raise ValueError("weights sum to zero")
    slim = df.select(label, *models).persist()
    try:
        best = sign * score_weights(slim, label, models, [weights.tolist()], metric)[0]
        for _ in range(max_sweeps):
            moves = _neighbours(weights, step)
            if not moves:
                break
            found = best_weights(slim, label, models, [w.tolist() for w in moves], metric, best)
            if found is not None:
                weights, best = moves[found[0]], found[1]
            else:
                step /= 2.0
                if step < smallest_step:
                    break
    finally:
        slim.unpersist()
    return {m: round(w, precision) for m, w in zip(models, weights.tolist())}, sign * best


def size_curve(df: DataFrame, label: str, models: Sequence[str]) -> DataFrame:
    """AUC of the mean of the first k models, for every k up to all given models, in one job."""
    models = list(models)
    means = [vectors.row_mean([F.col(m) for m in models[:k]]) for k in range(1, len(models) + 1)]
    long = df.select(label, F.posexplode(F.array(*means)).alias("position", "blend"))
    names = F.array(*[F.lit(m) for m in models])
    size = F.col("position") + 1
    return metrics.auc(long, label, "blend", ["position"]).select(
        size.alias("ensemble_size"),
        F.col("auc").alias("cv_score"),
        F.array_join(F.slice(names, F.lit(1), size), ",").alias("models"),
    )


# ------------------------------------------------------------------ diversity


def pair_measures(df: DataFrame, models: Sequence[str], metric: str = "correlation") -> DataFrame:
    """``(model_a, model_b, value)`` for every pair, from one aggregate."""
    make = {
        "correlation": lambda a, b: F.corr(a, b),
        "covariance": lambda a, b: F.covar_samp(a, b),
        "disagreement": lambda a, b: F.avg((decision(F.col(a)) != decision(F.col(b))).cast("double")),
    }.get(metric)
    if make is None:
        raise ValueError(f"Unknown diversity metric: {metric}")
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i + 1 :]]
    row = df.agg(*[make(a, b).alias(f"v{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"), F.col(f"v{i}").alias("value"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def diversity(df: DataFrame, models: Sequence[str], metric: str = "correlation") -> DataFrame:
    """One row: the average diversity (1 - mean, or the mean disagreement)."""
    mean = F.avg("value")
    value = mean if metric == "disagreement" else 1.0 - mean
    return pair_measures(df, models, metric).agg(value.alias("avg_diversity"))


def select_diverse(df: DataFrame, models: Sequence[str], n_select: int = 5, threshold: float = 0.95) -> list[str]:
    """Greedy choice from the first model on: most diverse next, none above ``threshold``."""
    found = pair_measures(df, models).collect()
    corr = {frozenset((r["model_a"], r["model_b"])): r["value"] for r in found}
    chosen = [models[0]]
    while len(chosen) < n_select:
        options = []
        for m in models:
            if m in chosen:
                continue
            links = [corr[frozenset((m, c))] for c in chosen]
            if max(links) < threshold:
                options.append((1.0 - sum(links) / len(links), m))
        if not options:
            break
        best = max(o[0] for o in options)
        chosen.append(next(m for gain, m in options if gain == best))
    return chosen
