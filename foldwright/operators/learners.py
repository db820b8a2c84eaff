"""What the cross-validation operators need from a model (V5).

A learner has ``fit(df, valid=None) -> model``; a model has ``score(df, name)``,
which adds its prediction: a probability for two classes, an array of
probabilities for more, a number for regression. ``probabilities(df, name)``
always adds the array. Anything with these methods can be used.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from itertools import pairwise
from operator import add
from typing import Any, Protocol

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegressionModel,
)
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.functions.vectors import argmax_label, one_hot, row_mean
from foldwright.plans.hot import attach
from foldwright.session import cut, scratch_path

_X, _Y, _W, _VALID = "__fw_x", "__fw_y", "__fw_w", "__fw_valid"
#: Trees are fitted on counts by bin where there can be no more combinations of bins than this.
MOST_CELLS = 2**21
#: Spark's trees choose their bins from so many rows, or the square of their number if that is more.
BIN_ROWS = 10_000
#: Trees of more nodes than this are walked by the model, as generated code has its limits.
MOST_NODES = 64


class Model(Protocol):
    def score(self, df: DataFrame, name: str) -> DataFrame: ...

    def probabilities(self, df: DataFrame, name: str) -> DataFrame: ...


class Learner(Protocol):
    def fit(self, df: DataFrame, valid: Column | None = None) -> Model: ...


def _present(name: str) -> Column:
    """The column as double, null unless it is a finite number."""
    value = F.col(name).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


@dataclass(frozen=True)
class SparkLearner:
    """Any ``pyspark.ml`` classifier or regressor on named columns or one array column.

    ``labels`` lists the class values in order; None means regression. A missing
    feature (null, NaN or infinite) counts as the mean of its column over the rows
    of the fit, 0 if none has a value: estimators refuse it, and a model would
    score NaN, which compares as greater than any threshold.
    """

    estimator: Estimator
    features: tuple[str, ...]
    label: str
    labels: tuple | None = (0, 1)
    weight: str | None = None

    def fills(self, rows: DataFrame) -> dict[str, float]:
        """What a missing value of each numeric feature counts as."""
        names = [f for f in self.features if isinstance(rows.schema[f].dataType, (T.NumericType, T.BooleanType))]
        if not names:
            return {}
        means = rows.agg(*[F.avg(_present(f)).alias(f"__fw_f{i}") for i, f in enumerate(names)]).first()
        return {f: 0.0 if mean is None else mean for f, mean in zip(names, means, strict=True)}

    def vectorised(self, df: DataFrame, fills: dict[str, float], limits: dict[str, list[float]] | None = None) -> DataFrame:
        """The features as one vector; with ``limits``, of how many of them a value has passed."""
        if len(self.features) == 1 and isinstance(df.schema[self.features[0]].dataType, T.ArrayType):
            return df.withColumn(_X, array_to_vector(F.col(self.features[0]).cast("array<double>")))
        whole = {f: f"__fw_f{i}" for i, f in enumerate(fills)}
        out = df.withColumns({name: F.coalesce(_present(f), F.lit(fills[f])) for f, name in whole.items()})
        for f, ends in (limits or {}).items():
            out = _binned(out, whole[f], ends)
        inputs = [whole.get(f, f) for f in self.features]
        return VectorAssembler(inputCols=inputs, outputCol=_X, handleInvalid="keep").transform(out).drop(*whole.values())

    def counts_do(self, rows: DataFrame) -> bool:
        """Whether the estimator sees no more of the rows than how many there are by label and bins, and these are few."""
        tree = self.estimator
        if type(tree) not in (DecisionTreeClassifier, GBTClassifier) or self.weight is not None:
            return False
        if tree.getMinInstancesPerNode() > 1 or (isinstance(tree, GBTClassifier) and tree.getSubsamplingRate() < 1.0):
            return False
        numeric = all(isinstance(rows.schema[f].dataType, (T.NumericType, T.BooleanType)) for f in self.features)
        named = any("ml_attr" in rows.schema[f].metadata for f in self.features)
        unlike = len(set(self.features)) == len(self.features)
        return numeric and not named and unlike and tree.getMaxBins() ** len(self.features) <= MOST_CELLS

    def limits(self, rows: DataFrame, fills: dict[str, float]) -> dict[str, list[float]]:
        """The ends of each feature's bins, from the rows that the estimator would choose them from."""
        spark, n, bins = rows.sparkSession, rows.count(), self.estimator.getMaxBins()
        whole = rows.select(*[F.coalesce(_present(f), F.lit(fills[f])).alias(f"__fw_f{i}") for i, f in enumerate(self.features)])
        share = min(1.0, max(bins * bins, BIN_ROWS) / max(n, 1))
        if share < 1.0:
            seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(self.estimator.getSeed()).nextInt()
            chosen = whole._jdf.toJavaRDD().sample(False, share, seed)
            whole = DataFrame(spark._jsparkSession.createDataFrame(chosen, whole._jdf.schema()), spark)
        seen = list(zip(*whole.collect())) or [()] * len(self.features)
        return {f: _between(values, min(bins, n), share * n) for f, values in zip(self.features, seen, strict=True)}

    def _counted(self, rows: DataFrame, fills: dict[str, float], limits: dict[str, list[float]], keep: list[str]) -> DataFrame:
        """A row for each label and combination of bins, with the number of rows as its weight."""
        whole = {f: f"__fw_f{i}" for i, f in enumerate(fills)}
        out = rows.select(*[F.coalesce(_present(f), F.lit(fills[f])).alias(name) for f, name in whole.items()], *keep)
        for f, ends in limits.items():
            out = _binned(out, whole[f], ends)
        cells = out.groupBy(*whole.values(), *keep).agg(F.count(F.lit(1)).cast("double").alias(_W))
        inputs = [whole[f] for f in self.features]
        return VectorAssembler(inputCols=inputs, outputCol=_X, handleInvalid="keep").transform(cells).select(_X, *keep, _W)

    def fit(self, df: DataFrame, valid: Column | None = None) -> SparkModel:
        """``valid`` marks rows for early stopping where the estimator can use them."""
        # the means and the fit read what may be costly to derive
        rows, keep = self._rows(df, valid)
        rows = rows.persist()
        try:
            return self._fitted(rows, keep)
        finally:
            rows.unpersist()

    def fit_written(self, df: DataFrame, valid: Column | None = None) -> SparkModel:
        """``fit`` on rows of a written table, which are read again instead of kept."""
        return self._fitted(*self._rows(df, valid))

    def _stops_early(self) -> bool:
        return self.estimator.hasParam("validationIndicatorCol")

    def _rows(self, df: DataFrame, valid: Column | None) -> tuple[DataFrame, list[str]]:
        """The features and what else the fit reads of the labelled rows, and the names of the latter."""
        y = F.col(self.label).cast("double")
        if self.labels is not None and tuple(self.labels) != tuple(range(len(self.labels))):
            known = F.array(*[F.lit(v) for v in self.labels])
            y = (F.array_position(known, F.col(self.label)) - 1).cast("double")
        rows = df.withColumn(_Y, y).filter(F.col(_Y).isNotNull())
        keep = [_Y]
        if self.weight is not None:
            rows = rows.withColumn(_W, F.col(self.weight).cast("double"))
            keep.append(_W)
        if valid is not None and self._stops_early():
            rows = rows.withColumn(_VALID, valid)
            keep.append(_VALID)
        elif valid is not None:
            rows = rows.filter(~valid)
        return rows.select(*self.features, *keep), keep

    def _fitted(self, rows: DataFrame, keep: list[str]) -> SparkModel:
        # early stopping may set parameters, so work on a copy
        estimator = self.estimator.copy()
        estimator = estimator.setFeaturesCol(_X).setLabelCol(_Y)
        if self.weight is not None:
            estimator = estimator.setWeightCol(_W)
        if _VALID in keep:
            estimator = estimator.setValidationIndicatorCol(_VALID)
        seen = rows.filter(~F.col(_VALID)) if _VALID in keep else rows
        fills = self.fills(seen)
        if not self.counts_do(rows):
            return SparkModel(self, estimator.fit(self.vectorised(rows, fills).select(_X, *keep)), fills)
        limits = self.limits(seen, fills)
        cells = self._counted(rows, fills, limits, keep).persist()
        try:
            # the estimator looks for bins in maxBins x maxBins rows at most; they are found already, so it shall see all
            most = math.isqrt(cells.count()) + 1
            estimator = estimator.setWeightCol(_W).setMaxBins(max(most, estimator.getMaxBins()))
            return SparkModel(self, estimator.fit(cells), fills, limits)
        finally:
            cells.unpersist()


def _between(values: Sequence[float], bins: int, rows: float | None = None) -> list[float]:
    """Limits half-way between neighbouring values: all, or the ``bins - 1`` nearest to even shares, as Spark's trees choose them.

    They count what is missing from ``rows``, the rows to be expected, as zeros.
    """
    rows = len(values) if rows is None else rows
    found = Counter(v for v in values if v != 0.0)
    zeros = rows - found.total()
    if found and zeros > 100 * len(values) * 2.0**-52:
        found[0.0] = zeros
    counts = sorted(found.items())
    if len(counts) <= bins:
        return [(a + b) / 2 for (a, _), (b, _) in pairwise(counts)]
    out: list[float] = []
    share = rows / bins
    passed, wanted = counts[0][1], share
    for (a, _), (b, n) in pairwise(counts):
        before, passed = passed, passed + n
        if abs(before - wanted) < abs(passed - wanted):
            out.append((a + b) / 2)
            wanted += share
    return out


def _binned(df: DataFrame, name: str, limits: Sequence[float]) -> DataFrame:
    """The column as the number of limits strictly below it."""
    if not limits:
        return df.withColumn(name, F.lit(0.0))
    # a bucket holds its lower end, a tree's left branch its upper one
    splits = sorted({math.nextafter(v, math.inf) for v in limits})
    into = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=name, outputCol="__fw_bin", handleInvalid="keep")
    # a sum, as the bare column is marked as categories, which trees would part without regard to order
    return into.transform(df).withColumn(name, F.col("__fw_bin") + F.lit(0.0)).drop("__fw_bin")


@dataclass(frozen=True)
class SparkModel:
    learner: SparkLearner
    fitted: Any
    fills: dict[str, float] = field(default_factory=dict)
    limits: dict[str, list[float]] = field(default_factory=dict)

    @property
    def importances(self) -> list[float] | None:
        """Feature importances, or absolute coefficients of a linear model."""
        if hasattr(self.fitted, "featureImportances"):
            return [float(v) for v in self.fitted.featureImportances.toArray()]
        if getattr(self.fitted, "numClasses", 2) == 2 and hasattr(self.fitted, "coefficients"):
            return [abs(float(v)) for v in self.fitted.coefficients.toArray()]
        return None

    @cached_property
    def scorer(self) -> Any:
        """The fitted model, read back without its training summary.

        A summary names the session, and whatever the session holds (any
        observation, the caller's as well) would have to go to the tasks.
        """
        if not getattr(self.fitted, "hasSummary", False):
            return self.fitted
        path = scratch_path(self.fitted.summary.predictions.sparkSession, "model")
        self.fitted.write().save(path)
        return type(self.fitted).load(path)

    def _raw(self, df: DataFrame, column: str) -> DataFrame:
        model = self.scorer.copy()
        for out in ("predictionCol", "probabilityCol", "rawPredictionCol"):
            if model.hasParam(out):
                model.set(model.getParam(out), f"__fw_{out}" if out == column else "")
        return model.transform(self.learner.vectorised(df, self.fills, self.limits)).drop(_X)

    @cached_property
    def formula(self) -> list[Column] | None:
        """The class probabilities as columns of the whole features ``__fw_f0``, ..., for models of which that is short.

        The model itself makes a vector of every row and takes it apart again.
        """
        model, learner = self.fitted, self.learner
        if learner.labels is None or set(self.fills) != set(learner.features) or model.numClasses != len(learner.labels):
            return None
        names = {f: f"__fw_f{i}" for i, f in enumerate(self.fills)}
        xs = [F.col(names[f]) for f in learner.features]
        ends = [self.limits.get(f) for f in learner.features]
        if isinstance(model, LogisticRegressionModel) and model.coefficientMatrix.numRows == 1:
            margin = reduce(add, [x * F.lit(float(w)) for x, w in zip(xs, model.coefficients.toArray())]) + F.lit(model.intercept)
            first = 1.0 / (1.0 + F.exp(margin))
            return [first, 1.0 - first]
        if isinstance(model, GBTClassificationModel) and model.totalNumNodes <= MOST_NODES:
            leaf = lambda node: node.prediction()
            trees = [_walk(tree._java_obj.rootNode(), xs, ends, leaf) for tree in model.trees]
            if any(t is None for t in trees):
                return None
            margin = reduce(add, [t * F.lit(float(w)) for t, w in zip(trees, model.treeWeights)])
            first = 1.0 / (1.0 + F.exp(2.0 * margin))
            return [first, 1.0 - first]
        if isinstance(model, DecisionTreeClassificationModel) and model.numNodes <= MOST_NODES:
            leaf = lambda node: _shares(node, k)
            out = []
            for k in range(model.numClasses):
                out.append(_walk(model._java_obj.rootNode(), xs, ends, leaf))
            return None if any(c is None for c in out) else out
        return None

    def _stated(self, df: DataFrame, name: str, value: Column) -> DataFrame:
        """Add what ``formula`` says."""
        whole = {f: f"__fw_f{i}" for i, f in enumerate(self.fills)}
        out = df.withColumns({n: F.coalesce(_present(f), F.lit(self.fills[f])) for f, n in whole.items()})
        return out.withColumn(name, value).drop(*whole.values())

    def probabilities(self, df: DataFrame, name: str) -> DataFrame:
        if self.formula is not None:
            return self._stated(df, name, F.array(*self.formula))
        if not self.fitted.hasParam("probabilityCol"):
            k = len(self.learner.labels)
            out = self._raw(df, "predictionCol")
            return out.withColumn(name, one_hot(F.col("__fw_predictionCol").cast("int"), k)).drop("__fw_predictionCol")
        out = self._raw(df, "probabilityCol")
        return out.withColumn(name, vector_to_array("__fw_probabilityCol")).drop("__fw_probabilityCol")

    def score(self, df: DataFrame, name: str) -> DataFrame:
        if self.learner.labels is None:
            return self._raw(df, "predictionCol").withColumnRenamed("__fw_predictionCol", name)
        if self.formula is not None and len(self.learner.labels) == 2:
            return self._stated(df, name, self.formula[1])
        out = self.probabilities(df, name)
        return out.withColumn(name, F.element_at(name, 2)) if len(self.learner.labels) == 2 else out


def _shares(node: Any, k: int) -> float:
    """The share of class ``k`` in a leaf."""
    stats = [float(v) for v in node.impurityStats().stats()]
    return stats[k] / sum(stats) if sum(stats) else stats[k]


def _walk(node: Any, xs: Sequence[Column], ends: Sequence[list[float] | None], leaf: Any) -> Column | None:
    """What ``leaf`` says of the leaf that a row comes to; None for trees that part categories.

    ``ends`` are the limits of features that the tree knows as bins.
    """
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(leaf(node)))
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        return None
    at, limit = split.featureIndex(), split.threshold()
    if ends[at] is not None:
        limit = ends[at][math.floor(limit)]
    left, right = (_walk(child, xs, ends, leaf) for child in (node.leftChild(), node.rightChild()))
    return None if left is None or right is None else F.when(xs[at] <= F.lit(float(limit)), left).otherwise(right)


@dataclass(frozen=True)
class GroupMeanLearner:
    """Predicts the smoothed label mean of the row's key: fit is one aggregate."""

    keys: tuple[str, ...]
    label: str
    smoothing: float = 10.0
    labels: tuple | None = (0, 1)

    def fit(self, df: DataFrame, valid: Column | None = None) -> GroupMeanModel:
        rows = df if valid is None else df.filter(~valid)
        y = F.col(self.label).cast("double")
        overall = rows.agg(F.avg(y)).first()[0]
        known = rows
        for key in self.keys:
            known = known.filter(F.col(key).isNotNull())
        sums = known.groupBy(*self.keys).agg(F.sum(y).alias("__fw_t"), F.count(y).alias("__fw_m"))
        s = F.lit(float(self.smoothing))
        value = F.try_divide(F.coalesce("__fw_t", F.lit(0.0)) + s * F.lit(overall), F.col("__fw_m") + s)
        # fitting is eager, like any model's: later scoring must not repeat it
        return GroupMeanModel(self, cut(sums.select(*self.keys, value.alias("__fw_v"))), overall)


@dataclass(frozen=True)
class GroupMeanModel:
    learner: GroupMeanLearner | GroupShareLearner
    state: DataFrame
    overall: float | None
    importances: list[float] | None = field(default=None)

    def score(self, df: DataFrame, name: str) -> DataFrame:
        out = attach(df, self.state, self.learner.keys)
        return out.withColumn(name, F.coalesce("__fw_v", F.lit(self.overall).cast("double"))).drop("__fw_v")

    def probabilities(self, df: DataFrame, name: str) -> DataFrame:
        return self.score(df, name).withColumn(name, F.array(1.0 - F.col(name), F.col(name)))


@dataclass(frozen=True)
class GroupShareLearner:
    """The share of all rows that have the row's key: a transformer that needs no label."""

    keys: tuple[str, ...]
    importances: list[float] | None = field(default=None)

    def fit(self, df: DataFrame, valid: Column | None = None) -> GroupMeanModel:
        rows = df if valid is None else df.filter(~valid)
        n = rows.count()
        known = rows.dropna(subset=list(self.keys)).groupBy(*self.keys).agg(F.count(F.lit(1)).alias("__fw_c"))
        return GroupMeanModel(self, cut(known.select(*self.keys, (F.col("__fw_c") / F.lit(float(n))).alias("__fw_v"))), 0.0)


@dataclass(frozen=True)
class RowMeanLearner:
    """Predicts the mean of its features: a meta learner with nothing to fit."""

    features: tuple[str, ...]
    importances: list[float] | None = field(default=None)

    def fit(self, df: DataFrame, valid: Column | None = None) -> RowMeanLearner:
        return self

    def score(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, row_mean([F.col(f) for f in self.features]))

    def probabilities(self, df: DataFrame, name: str) -> DataFrame:
        return self.score(df, name).withColumn(name, F.array(1.0 - F.col(name), F.col(name)))


def predicted_label(name: str, labels: Sequence) -> Column:
    """The label value a probability array stands for."""
    return argmax_label(F.col(name), labels)


def detect_task(df: DataFrame, label: str, most: int = 20) -> str:
    """The default rule when no task is given: few distinct targets mean classes."""
    return "classification" if df.select(label).distinct().limit(most + 1).count() <= most else "regression"
