"""Out-of-fold predictions, stacking and adversarial validation.

The fold frame is written once, so that the k (times M) fits read the columns they
need and leave the memory to the models; predictions are written as well, and
outlive the loss of an executor. The driver holds models and scores only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions import vectors
from foldwright.functions.names import as_list
from foldwright.operators import metrics
from foldwright.operators.learners import Learner, Model
from foldwright.operators.splits import FOLD, kfold
from foldwright.session import cut, stage

#: Fits on more rows than this keep the machines busy one by one, and several would share the memory.
ROWS_AT_ONCE = 20_000_000

_AVERAGES: dict[str, Callable] = {
    "mean": vectors.row_mean,
    "median": vectors.row_median,
    "geometric": vectors.row_geometric_mean,
}


def _fit_all(jobs: Sequence[Callable[[], Model]], parallelism: int) -> list[Model]:
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


def _fit(learner: Learner, rows: DataFrame, **options: Any) -> Model:
    """Fit on rows of a written table, which need no copy where a learner knows how to do without."""
    return getattr(learner, "fit_written", learner.fit)(rows, **options)


def _at_once(rows: DataFrame, parallelism: int) -> int:
    return parallelism if rows.count() <= ROWS_AT_ONCE else 1


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def average_models(df: DataFrame, models: Sequence[Model], name: str, averaging: str = "mean") -> DataFrame:
    """Score with every model in one pass over the rows and combine the scores."""
    if averaging not in _AVERAGES:
        raise ValueError(f"no such way to average: {averaging}")
    out, scores = df, []
    for i, model in enumerate(models):
        scores.append(f"__fw_s{i}")
        out = model.score(out, scores[-1])
    if dict(out.dtypes)[scores[0]].startswith("array"):
        if averaging != "mean":
            raise ValueError("class probabilities are averaged by 'mean' only")
        value = vectors.mean_of_arrays([F.col(s) for s in scores])
    else:
        value = _AVERAGES[averaging]([F.col(s) for s in scores])
    return out.withColumn(name, value).drop(*scores)


def _sides(fold: str, role: str | None, k: int) -> tuple[Column, Column]:
    """Training and held-out rows of fold ``k``: all other folds, or what the roles of a split say."""
    held = F.col(fold) == k
    if role is None:
        return F.col(fold) != k, held
    return held & (F.col(role) == "train"), held & (F.col(role) == "test")


@dataclass
class OutOfFold:
    """Fold models of one learner, their out-of-fold predictions and scores.

    With ``role``, rows are the long ``(split, role)`` table of a time or purged
    split: ``fold`` names the split column and a row trains only where it says so.
    """

    learner: Learner
    label: str
    fold: str = FOLD
    role: str | None = None
    n_folds: int = 5
    metric: str | Callable | None = None
    early_stopping: bool = True
    parallelism: int = 4
    models: list[Model] = field(default_factory=list)
    predictions: DataFrame | None = None

    def fit_predict(self, df: DataFrame, id_cols: str | Sequence[str], name: str = "oof") -> DataFrame:
        """Fit on the other folds, predict the held-out one: ``(ids, label, fold, oof)``."""
        df = stage(df, "fold-rows")
        sides = [_sides(self.fold, self.role, k) for k in range(self.n_folds)]

        def job(train: Column, test: Column) -> Callable[[], Model]:
            if self.early_stopping:
                return lambda: _fit(self.learner, df.filter(train | test), valid=test)
            return lambda: _fit(self.learner, df.filter(train))

        # a fresh list: fitting again never mixes with earlier models
        self.models = _fit_all([job(*s) for s in sides], _at_once(df, self.parallelism))
        parts = [m.score(df.filter(test), name) for m, (_, test) in zip(self.models, sides)]
        slim = [p.select(*as_list(id_cols), self.label, self.fold, name) for p in parts]
        self.predictions = stage(_union(slim), "oof")
        return self.predictions

    def scores(self, name: str = "oof", n_classes: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Per-fold scores, and their mean and population standard deviation."""
        if self.predictions is None:
            raise RuntimeError("call fit_predict first")
        return metrics.fold_scores(self.predictions, self.label, name, self.fold, self.metric, n_classes)

    def predict(self, df: DataFrame, name: str = "prediction", averaging: str = "mean") -> DataFrame:
        if not self.models:
            raise RuntimeError("call fit_predict before predict")
        return average_models(df, self.models, name, averaging)

    def importances(self, features: Sequence[str]) -> list[tuple[str, float]] | None:
        """Mean importance per feature over the fold models."""
        found = [m.importances for m in self.models if getattr(m, "importances", None) is not None]
        if not found:
            return None
        return [(f, sum(v[i] for v in found) / len(found)) for i, f in enumerate(features)]


@dataclass
class Stack:
    """Base learners, out-of-fold meta features ``meta_{model}``, and a meta learner.

    ``meta`` builds the meta learner from its feature names, so the same stack
    works with or without ``passthrough`` columns. ``role`` is as in ``OutOfFold``.
    """

    base: dict[str, Learner]
    meta: Callable[[list[str]], Learner]
    label: str
    fold: str = FOLD
    role: str | None = None
    n_folds: int = 5
    n_classes: int = 2
    passthrough: tuple[str, ...] = ()
    parallelism: int = 4
    base_models: dict[str, list[Model]] = field(default_factory=dict)
    meta_model: Any = None
    meta_features: list[str] = field(default_factory=list)

    def _widen(self, df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """Class-probability arrays become one column per class."""
        cols: list[str] = []
        for n in names:
            if dict(df.dtypes)[n].startswith("array"):
                split = {f"{n}_{k}": F.element_at(n, k + 1) for k in range(self.n_classes)}
                df = df.withColumns(split).drop(n)
                cols += list(split)
            else:
                cols.append(n)
        return df, cols

    def fit(self, df: DataFrame, id_cols: str | Sequence[str]) -> DataFrame:
        """Fit everything; returns the out-of-fold meta table.

        Each fold's rows pass through that fold's model of every learner in one
        projection, so the wide table needs no pivot and no shuffle. Group folds
        in ``fold`` are honoured because every learner uses the same column.
        """
        df = stage(df, "fold-rows")
        sides = [_sides(self.fold, self.role, k) for k in range(self.n_folds)]
        jobs = [
            (lambda learner=learner, k=k: _fit(learner, df.filter(sides[k][0])))
            for learner in self.base.values()
            for k in range(self.n_folds)
        ]
        fitted = _fit_all(jobs, _at_once(df, self.parallelism))
        k = self.n_folds
        self.base_models = {n: fitted[i * k : (i + 1) * k] for i, n in enumerate(self.base)}
        names = [f"meta_{n}" for n in self.base]
        parts = []
        for f in range(k):
            part = df.filter(sides[f][1])
            for n, meta in zip(self.base, names):
                part = self.base_models[n][f].score(part, meta)
            parts.append(part)
        whole, names = self._widen(_union(parts), names)
        keep = [*as_list(id_cols), self.label, self.fold, *names, *self.passthrough]
        table = stage(whole.select(*dict.fromkeys(keep)), "meta-rows")
        self.meta_features = [*names, *self.passthrough]
        self.meta_model = _fit(self.meta(self.meta_features), table)
        return table

    def meta_table(self, df: DataFrame, averaging: str = "mean") -> DataFrame:
        """``meta_{model}`` for new rows: the average of each learner's fold models."""
        if self.meta_model is None:
            raise RuntimeError("call fit first")
        out = df
        for n, models in self.base_models.items():
            out = average_models(out, models, f"meta_{n}", averaging)
        return self._widen(out, [f"meta_{n}" for n in self.base_models])[0]

    def predict(self, df: DataFrame, name: str = "prediction", averaging: str = "mean") -> DataFrame:
        return self.meta_model.score(self.meta_table(df, averaging), name)

    def importances(self) -> list[tuple[str, float]] | None:
        found = getattr(self.meta_model, "importances", None)
        return None if found is None else list(zip(self.meta_features, found))


@dataclass
class FoldFeatures:
    """Named transformers fitted out of fold (E10): a column ``oof_{name}`` each.

    A transformer is anything with ``fit`` and ``score``, whether it looks at the
    label or not. Training rows see what was fitted on the other folds, new rows
    the average of all fold fits.
    """

    transformers: dict[str, Learner]
    fold: str = FOLD
    n_folds: int = 5
    parallelism: int = 4
    fitted: dict[str, list[Model]] = field(default_factory=dict)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        held, k = F.col(self.fold), self.n_folds
        try:
            jobs = [
                (lambda t=t, i=i: t.fit(df.filter(held != i))) for t in self.transformers.values() for i in range(k)
            ]
            models = _fit_all(jobs, self.parallelism)
            self.fitted = {n: models[i * k : (i + 1) * k] for i, n in enumerate(self.transformers)}
            parts = []
            for i in range(k):
                part = df.filter(held == i)
                for name, found in self.fitted.items():
                    part = found[i].score(part, f"oof_{name}")
                parts.append(part)
            return cut(_union(parts))
        finally:
            df.unpersist()

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.fitted:
            raise RuntimeError("call fit_transform first")
        for name, models in self.fitted.items():
            df = average_models(df, models, f"oof_{name}")
        return df


def adversarial_validation(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    id_col: str,
    learner: Callable[[str], Learner],
    threshold: float = 0.5,
    n_folds: int = 3,
    seed: int = 42,
) -> tuple[DataFrame, list[tuple[str, float]] | None]:
    """Can a model tell test rows from train rows? AUC near 0.5 means it cannot.

    Returns the one-row ``(auc, n_pos, n_neg, shifted)`` and the importances.
    ``learner`` builds a learner for the given label column.
    """
    side = "__fw_side"
    both = train.select(id_col, *features, F.lit(0).alias(side)).unionByName(
        test.select(id_col, *features, F.lit(1).alias(side))
    )
    both = kfold(both.withColumn("__fw_id", F.concat_ws("_", side, id_col)), "__fw_id", n_folds, seed)
    run = OutOfFold(learner(side), side, n_folds=n_folds, early_stopping=False)
    found = metrics.auc(run.fit_predict(both, id_col), side, "oof")
    return found.withColumn("shifted", F.col("auc") > threshold), run.importances(features)


def long_predictions(wide: DataFrame, id_cols: str | Sequence[str], models: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide predictions to ``(ids, model, pred)`` rows."""
    cells = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models])
    return wide.select(*as_list(id_cols), *keep, F.explode(cells).alias("c")).select(*as_list(id_cols), *keep, "c.*")


def wide_predictions(long: DataFrame, id_cols: str | Sequence[str], models: Sequence[str], prefix: str = "meta_") -> DataFrame:
    """``(ids, model, pred)`` rows to one ``meta_{model}`` column per model."""
    made = [F.max(F.when(F.col("model") == m, F.col("pred"))).alias(f"{prefix}{m}") for m in models]
    return long.groupBy(*as_list(id_cols)).agg(*made)
