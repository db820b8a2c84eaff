"""Distillation data sets, students and temperature analysis."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions import vectors
from foldwright.operators import metrics
from foldwright.operators.learners import Learner, Model
from foldwright.operators.pseudo import append_soft
from foldwright.operators.splits import exact_sample

SOFT = "soft_label"


def teacher_mean(
    df: DataFrame,
    arrays: Sequence[str],
    temperature: float = 1.0,
    weights: dict[str, float] | None = None,
    name: str = SOFT,
    kind: str = "probability",
) -> DataFrame:
    """(Weighted) mean of the teachers' class vectors after temperature scaling."""
    scaled = [
        vectors.temperature_scale(F.col(a), temperature, kind) if temperature != 1.0 or kind == "logit" else F.col(a)
        for a in arrays
    ]
    w = None if weights is None else [weights.get(a, 1.0) for a in arrays]
    return df.withColumn(name, vectors.mean_of_arrays(scaled, w))


def soft_rows(
    df: DataFrame, n_classes: int, soft: str = SOFT, label: str | None = None, alpha: float = 1.0
) -> DataFrame:
    """One weighted row per class: true soft labels for any learner with weights.

    The weight is ``alpha * p(class)``, plus ``1 - alpha`` for the hard label.
    """
    weight = F.col(soft)
    if label is not None and alpha < 1.0:
        hard = vectors.one_hot(F.col(label), n_classes)
        weight = F.zip_with(weight, hard, lambda p, h: F.lit(alpha) * p + F.lit(1.0 - alpha) * h)
    out = df.withColumn("__fw_w", weight).select("*", F.posexplode("__fw_w").alias("class", "weight"))
    return out.drop("__fw_w").filter(F.col("weight") > 0)


@dataclass
class Distiller:
    """Teachers fitted on labels, a student fitted on what they say.

    ``student`` must weigh rows by ``weight`` and learn the column ``class``.
    """

    teachers: dict[str, Learner]
    student: Learner
    n_classes: int = 2
    temperature: float = 3.0
    alpha: float = 1.0
    weights: dict[str, float] | None = None
    fitted: dict[str, Model] = field(default_factory=dict)
    fitted_student: Model | None = None

    def fit_teachers(self, df: DataFrame) -> None:
        self.fitted = {n: t.fit(df) for n, t in self.teachers.items()}

    def soft_labels(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise RuntimeError("call fit_teachers first")
        out = df
        for n, model in self.fitted.items():
            out = model.probabilities(out, n)
        return teacher_mean(out, list(self.fitted), self.temperature, self.weights).drop(*self.fitted)

    def distill(self, df: DataFrame, label: str | None = None) -> Model:
        """Fit the student on soft labels for ``df`` (mixed with ``label`` if alpha < 1)."""
        rows = soft_rows(self.soft_labels(df), self.n_classes, label=label, alpha=self.alpha)
        self.fitted_student = self.student.fit(rows)
        return self.fitted_student

    def evaluate(self, df: DataFrame, label: str, metric: str | Callable = "auc") -> DataFrame:
        """``(model, score)`` for every teacher and the student, in one pass over the rows."""
        models = {f"teacher_{n}": m for n, m in self.fitted.items()}
        if self.fitted_student is not None:
            models["student"] = self.fitted_student
        out = df.select("*")
        for n, model in models.items():
            out = model.score(out, n)
        cells = F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("pred")) for n in models])
        long = out.select(F.col(label).alias("y"), F.explode(cells).alias("c")).select("y", "c.*")
        return metrics.score(long, "y", "pred", metric, ["model"])


def distillation_dataset(
    labelled: DataFrame,
    unlabelled: DataFrame,
    teachers: Sequence[Model],
    label: str,
    id_col: str,
    n_classes: int,
    keep: Sequence[str],
    temperature: float = 3.0,
    sample_ratio: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """Labelled rows one-hot plus a sample of the others with the teachers' soft labels."""
    out, names = exact_sample(unlabelled, id_col, sample_ratio, seed), []
    for i, model in enumerate(teachers):
        names.append(f"__fw_t{i}")
        out = model.probabilities(out, names[-1])
    return append_soft(labelled, teacher_mean(out, names, temperature), label, n_classes, keep, SOFT)


def temperature_analysis(
    df: DataFrame, probabilities: str, label: str, temperatures: Sequence[float] = (1, 2, 3, 5, 10)
) -> DataFrame:
    """Mean entropy and accuracy per temperature; one aggregate, no extra rows.

    Scaling keeps the order of the classes, so accuracy does not depend on it.
    """
    right = (vectors.argmax(F.col(probabilities)) == F.col(label)).cast("double")
    row = df.agg(
        F.avg(right).alias("accuracy"),
        *[
            F.avg(vectors.entropy(vectors.power_scale(F.col(probabilities), float(t)))).alias(f"e{i}")
            for i, t in enumerate(temperatures)
        ],
    )
    cells = [
        F.struct(F.lit(float(t)).alias("temperature"), F.col(f"e{i}").alias("entropy"), F.col("accuracy"))
        for i, t in enumerate(temperatures)
    ]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def distillation_loss(
    student_logits: Column, teacher: Column, temperature: float, alpha: float = 1.0, label: Column | None = None
) -> Column:
    """Row loss ``a * T^2 * KL(teacher, softened student) + (1 - a) * CE(label, student)``."""
    soft = vectors.temperature_scale(student_logits, temperature, "logit")
    loss = vectors.kl_divergence(teacher, soft) * F.lit(float(temperature) ** 2)
    if label is None or alpha >= 1.0:
        return loss
    hard = -F.ln(F.element_at(vectors.softmax(student_logits), label + 1))
    return F.lit(alpha) * loss + F.lit(1.0 - alpha) * hard
