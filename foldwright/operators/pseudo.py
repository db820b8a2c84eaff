"""Pseudo-labelling (M14-M19) and its row operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.functions import vectors
from foldwright.functions.names import as_list
from foldwright.operators import metrics
from foldwright.operators.learners import Learner, Model, predicted_label
from foldwright.operators.splits import exact_sample
from foldwright.plans.cuts import order_cuts
from foldwright.session import cut

PROBS, CONFIDENCE, ORIGIN = "probabilities", "confidence", "origin"


def confident(df: DataFrame, threshold: float, confidence: str = CONFIDENCE) -> DataFrame:
    return df.filter(F.col(confidence) >= threshold)


def top_confident(df: DataFrame, id_col: str, k: int, confidence: str = CONFIDENCE) -> DataFrame:
    """The k most confident rows, ties by id; k may be a share of a huge table."""
    cuts = order_cuts(df, confidence, id_col, lambda n: [k], descending=True)
    return df.filter(cuts.before(k))


def min_max_scaled(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Scores outside [0, 1] are mapped there by minimum and maximum; others stay."""
    limits = df.agg(F.min(col).alias("__fw_lo"), F.max(col).alias("__fw_hi"))
    lo, hi = F.col("__fw_lo"), F.col("__fw_hi")
    scaled = (F.col(col) - lo) / (hi - lo + F.lit(1e-8))
    value = F.when((lo < 0) | (hi > 1), scaled).otherwise(F.col(col))
    return df.crossJoin(F.broadcast(limits)).withColumn(name or col, value).drop("__fw_lo", "__fw_hi")


def balanced_threshold(
    df: DataFrame, threshold: float, max_imbalance: float = 3.0, confidence: str = CONFIDENCE, label: str = "label"
) -> DataFrame:
    """Confident rows; if one class outnumbers the other too much, at ``0.8 * threshold``.

    The class counts are one row, so the decision is part of the plan.
    """
    counts = confident(df, threshold, confidence).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    decided = counts.agg(
        F.when((F.count(F.lit(1)) == 2) & (F.max("n") / (F.min("n") + 1) > max_imbalance), threshold * 0.8)
        .otherwise(threshold)
        .alias("__fw_t")
    )
    kept = df.crossJoin(F.broadcast(decided)).filter(F.col(confidence) >= F.col("__fw_t"))
    return kept.drop("__fw_t")


def append_rows(train: DataFrame, extra: DataFrame, label: str, origin: str = ORIGIN) -> DataFrame:
    """Training rows plus pseudo-labelled rows, told apart by ``origin``."""
    features = [c for c in train.columns if c in extra.columns]
    kind = dict(train.dtypes)[label]
    a = train.select(*features, F.lit("train").alias(origin))
    b = extra.select(
        *[F.col(c).cast(kind).alias(c) if c == label else F.col(c) for c in features], F.lit("pseudo").alias(origin)
    )
    return a.unionByName(b)


def append_soft(
    labelled: DataFrame, soft: DataFrame, label: str, n_classes: int, keep: Sequence[str], name: str = "soft_label"
) -> DataFrame:
    """Labelled rows as one-hot vectors plus rows with soft labels in ``name``."""
    a = labelled.select(*keep, vectors.one_hot(F.col(label), n_classes).alias(name), F.lit("train").alias(ORIGIN))
    return a.unionByName(soft.select(*keep, name, F.lit("pseudo").alias(ORIGIN)))


def with_guess(df: DataFrame, model: Model, labels: Sequence, label: str = "label") -> DataFrame:
    """Add class probabilities, their confidence and the label they stand for."""
    out = model.probabilities(df, PROBS)
    return out.withColumn(CONFIDENCE, vectors.confidence(F.col(PROBS))).withColumn(label, predicted_label(PROBS, labels))


def fold_guess(df: DataFrame, models: Sequence[Model], labels: Sequence, label: str = "label") -> DataFrame:
    """The same from the mean over fold models, in one pass over the rows.

    Two classes: confidence of the mean probability. More: mean of the folds' confidences.
    """
    out, names = df, []
    for i, model in enumerate(models):
        names.append(f"__fw_p{i}")
        out = model.probabilities(out, names[-1])
    mean = vectors.mean_of_arrays([F.col(n) for n in names])
    out = out.withColumn(PROBS, mean)
    sure = (
        vectors.confidence(F.col(PROBS))
        if len(labels) == 2
        else vectors.row_mean([vectors.confidence(F.col(n)) for n in names])
    )
    out = out.withColumn(CONFIDENCE, sure).withColumn(label, predicted_label(PROBS, labels))
    return out.drop(*names)


def confidence_stats(df: DataFrame, confidence: str = CONFIDENCE) -> DataFrame:
    return df.agg(
        F.avg(confidence).alias("mean"),
        F.stddev_pop(confidence).alias("std"),
        F.min(confidence).alias("min"),
        F.max(confidence).alias("max"),
    )


def pseudo_label(
    train: DataFrame,
    unlabelled: DataFrame,
    models: Sequence[Model],
    label: str,
    id_col: str,
    labels: Sequence = (0, 1),
    threshold: float = 0.9,
    sample_ratio: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """Training rows plus a sample of the confident unlabelled ones.

    ``models`` are the fold models of an out-of-fold run on ``train``. If no
    row is confident, the training rows come back alone.
    """
    guessed = fold_guess(unlabelled.drop(label), models, labels, label)
    sure = cut(confident(guessed, threshold).select(*[c for c in train.columns if c in (*unlabelled.columns, label)]))
    return append_rows(train, exact_sample(sure, id_col, sample_ratio, seed), label)


@dataclass
class Round:
    """What one round of an iterative run did."""

    iteration: int
    n_pseudo_labels: int
    total_size: int
    score: float | None
    mean_confidence: float | None = None


def _valid_score(model: Model, valid: DataFrame, label: str, metric: str | Callable) -> float:
    return metrics.score(model.score(valid, "__fw_valid_score"), label, "__fw_valid_score", metric).first()["score"]


def _slim(df: DataFrame, train: DataFrame) -> DataFrame:
    return df.select(*[c for c in train.columns if c in df.columns])


def iterate(
    train: DataFrame,
    unlabelled: DataFrame,
    learner: Learner,
    label: str,
    id_col: str,
    labels: Sequence = (0, 1),
    threshold: float = 0.9,
    sample_ratio: float = 0.5,
    max_iterations: int = 3,
    valid: DataFrame | None = None,
    metric: str | Callable = "auc",
    larger_is_better: bool | None = None,
    allow_repeat: bool = False,
    seed: int = 42,
) -> tuple[Model, list[Round], DataFrame]:
    """Fit, label the confident rows, sample, append, repeat.

    Keeps the model with the best validation score (else the last one, fitted
    on everything) and stops when nothing is confident. A row is labelled once
    unless ``allow_repeat``. Only the rows added in a round are materialised.
    """
    sign = 1.0 if _larger(metric, larger_is_better) else -1.0
    current, left = train, unlabelled.drop(label)
    size = train.count()
    best: tuple[float, Model] | None = None
    history: list[Round] = []
    for i in range(max_iterations):
        model = learner.fit(current)
        score = None if valid is None else _valid_score(model, valid, label, metric)
        if score is not None and (best is None or sign * score > best[0]):
            best = (sign * score, model)
        sure = cut(_slim(confident(with_guess(left, model, labels, label), threshold), train))
        added = cut(exact_sample(sure, id_col, sample_ratio, seed + i)) if sample_ratio < 1.0 else sure
        n = added.count()
        if n == 0:
            break
        size += n
        history.append(Round(i + 1, n, size, score))
        current = current.unionByName(added.select(*current.columns))
        if not allow_repeat:
            left = left.join(added.select(id_col), id_col, "left_anti")
    return (best[1] if best else learner.fit(current)), history, current


def _larger(metric: str | Callable, given: bool | None) -> bool:
    if given is not None:
        return given
    if callable(metric):
        raise ValueError("say whether larger is better for a metric of your own")
    return metrics.larger_is_better(metric)


def iterate_top(
    train: DataFrame,
    unlabelled: DataFrame,
    learner: Learner,
    label: str,
    id_col: str,
    labels: Sequence = (0, 1),
    threshold: float = 0.9,
    sample_ratio: float = 0.5,
    max_iterations: int = 3,
) -> tuple[Model, list[Round], DataFrame]:
    """Each round labels anew: at most ``int(n * ratio)`` most confident rows join the training rows."""
    current, model = train, None
    most = int(unlabelled.count() * sample_ratio)
    size = train.count()
    history: list[Round] = []
    for i in range(max_iterations):
        model = learner.fit(current)
        guessed = with_guess(unlabelled.drop(label), model, labels, label)
        keep = [*[c for c in train.columns if c in guessed.columns], CONFIDENCE]
        sure = cut(confident(guessed, threshold).select(*keep))
        if sure.count() > most:
            sure = cut(top_confident(sure, id_col, most))
        n, mean = sure.agg(F.count(F.lit(1)), F.avg(CONFIDENCE)).first()
        if n == 0:
            break
        history.append(Round(i + 1, n, size + n, None, mean))
        current = train.unionByName(sure.select(*train.columns))
    return model, history, current


def iterate_safely(
    train: DataFrame,
    unlabelled: DataFrame,
    learner: Learner,
    label: str,
    id_col: str,
    threshold: float = 0.9,
    max_iterations: int = 3,
    max_imbalance: float = 3.0,
    min_improvement: float = 0.001,
    valid: DataFrame | None = None,
    metric: str | Callable = "auc",
    larger_is_better: bool | None = None,
) -> tuple[Model, list[Round], DataFrame]:
    """Two classes, with checks: stops without improvement, loosens the threshold on imbalance."""
    sign = 1.0 if _larger(metric, larger_is_better) else -1.0
    current, left, size = train, unlabelled.drop(label), train.count()
    kept: Model | None = None
    last: float | None = None
    history: list[Round] = []
    for i in range(max_iterations):
        model = learner.fit(current)
        score = None if valid is None else _valid_score(model, valid, label, metric)
        if score is not None:
            if last is not None and sign * (score - last) < min_improvement:
                break
            last = score
        kept = model
        guessed = cut(_slim_with(with_guess(left, model, (0, 1), label), train, [CONFIDENCE]))
        added = cut(_slim(balanced_threshold(guessed, threshold, max_imbalance, label=label), train))
        n = added.count()
        size += n
        history.append(Round(i + 1, n, size, score))
        if n == 0:
            break
        current = current.unionByName(added.select(*current.columns))
        left = left.join(added.select(id_col), id_col, "left_anti")
    return kept, history, current


def _slim_with(df: DataFrame, train: DataFrame, more: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in train.columns if c in df.columns], *more)


def soft_pseudo_label(
    train: DataFrame,
    unlabelled: DataFrame,
    model: Model,
    label: str,
    id_col: str,
    n_classes: int,
    keep: Sequence[str],
    temperature: float = 1.0,
    sample_ratio: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """Labelled rows one-hot, a sample of the others with softened probabilities."""
    picked = exact_sample(unlabelled, id_col, sample_ratio, seed)
    soft = model.probabilities(picked, "soft_label")
    if temperature != 1.0:
        soft = soft.withColumn("soft_label", vectors.temperature_scale(F.col("soft_label"), temperature))
    return append_soft(train, soft, label, n_classes, as_list(keep))


def history_table(spark, rounds: Sequence[Round]) -> DataFrame:
    lines = [(r.iteration, r.n_pseudo_labels, r.total_size, r.score, r.mean_confidence) for r in rounds]
    schema = "iteration int, n_pseudo_labels long, total_size long, score double, mean_confidence double"
    return spark.createDataFrame(lines, schema)
