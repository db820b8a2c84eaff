"""Curriculum and self-paced training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.functions import vectors
from foldwright.operators import metrics
from foldwright.operators.learners import Learner, Model, predicted_label
from foldwright.operators.prep import fit_scaler, standardise
from foldwright.plans.cuts import order_cuts
from foldwright.plans.hot import attach
from foldwright.session import cut

DIFFICULTY = "difficulty"


def centroid_distance(
    df: DataFrame, label: str, features: Sequence[str], name: str = DIFFICULTY, keep_scaled: bool = False
) -> DataFrame:
    """Distance of each row to the centre of its own class, in standardised space.

    There are as many centres as classes.
    """
    scaled = {f: f"__fw_z_{f}" for f in features}
    copy = df.withColumns({z: F.col(f).cast("double") for f, z in scaled.items()})
    z = list(scaled.values())
    copy = standardise(copy, fit_scaler(copy, z), z)
    centres = copy.groupBy(label).agg(*[F.avg(c).alias(f"{c}_c") for c in z])
    out = attach(copy, centres, [label])
    away = vectors.euclidean(F.array(*z), F.array(*[F.col(f"{c}_c") for c in z]))
    out = out.withColumn(name, away).drop(*[f"{c}_c" for c in z])
    return out if keep_scaled else out.drop(*z)


def model_difficulty(
    df: DataFrame, model: Model, label: str, labels: Sequence, by: str = "confidence", name: str = DIFFICULTY
) -> DataFrame:
    """``1 - confidence``, or 0/1 error, of a model on labelled rows."""
    out = model.probabilities(df, "__fw_p")
    if by == "confidence":
        value = 1.0 - vectors.confidence(F.col("__fw_p"))
    elif by == "error":
        value = (predicted_label("__fw_p", labels) != F.col(label)).cast("double")
    else:
        raise ValueError(f"Unknown difficulty: {by}")
    return out.withColumn(name, value).drop("__fw_p")


def stage_sizes(n: int, n_stages: int, ratio: float) -> list[int]:
    sizes, size = [], int(n * ratio)
    for _ in range(n_stages):
        sizes.append(min(size, n))
        size = int(size / ratio)
    return sizes


def easiest(df: DataFrame, id_col: str, size: int, difficulty: str = DIFFICULTY) -> DataFrame:
    """The ``size`` easiest rows, ties by id."""
    return df.filter(order_cuts(df, difficulty, id_col, lambda n: [size]).before(size))


def train_curriculum(
    df: DataFrame,
    learner: Learner,
    label: str,
    id_col: str,
    features: Sequence[str],
    labels: Sequence = (0, 1),
    n_stages: int = 3,
    ratio: float = 0.5,
    by: str = "confidence",
) -> tuple[list[Model], list[int]]:
    """Train on growing prefixes, easiest first; difficulty is measured anew after each stage."""
    sizes = stage_sizes(df.count(), n_stages, ratio)
    ranked = cut(centroid_distance(df, label, features))
    models: list[Model] = []
    for stage, size in enumerate(sizes):
        models.append(learner.fit(easiest(ranked, id_col, size)))
        if stage < n_stages - 1:
            ranked = cut(model_difficulty(df, models[-1], label, labels, by))
    return models, sizes


def train_self_paced(
    df: DataFrame,
    learner: Learner,
    label: str,
    labels: Sequence = (0, 1),
    threshold: float = 0.1,
    growth: float = 1.2,
    target_accuracy: float = 0.9,
    n_stages: int = 5,
    valid: DataFrame | None = None,
) -> tuple[list[Model], list[tuple[float, int]]]:
    """Train, keep the rows that are easy enough for the model, loosen the limit, repeat."""
    current, models, stages = df, [], []
    for _ in range(n_stages):
        models.append(learner.fit(current))
        stages.append((threshold, current.count()))
        if valid is not None:
            guessed = models[-1].probabilities(valid, "__fw_p").withColumn("__fw_l", predicted_label("__fw_p", labels))
            right = metrics.score(
                guessed, label, "__fw_l", lambda y, p: F.avg((y == p).cast("double"))
            ).first()["score"]
            if right >= target_accuracy:
                break
        threshold = min(threshold * growth, 1.0)
        hard = model_difficulty(df, models[-1], label, labels)
        current = cut(hard.filter(F.col(DIFFICULTY) <= threshold).select(*df.columns))
        if current.isEmpty():
            break
    return models, stages
