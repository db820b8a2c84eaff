"""Learners that need one or two aggregates: a histogram stump and least squares (V5).

Fits read the rows twice, first for ranges or means, then for counts and sums
per bin or for centred products; both are combined where rows are read. The
driver holds ``features * bins`` or ``features ** 2`` numbers, whatever the
number of rows. Missing and infinite feature values take no part in a fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(name: str) -> Column:
    """The value as a double; null if missing or not finite."""
    value = F.col(name).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def _training(df: DataFrame, label: str, valid: Column | None) -> DataFrame:
    rows = df if valid is None else df.filter(~valid)
    return rows.filter(F.col(label).isNotNull())


@dataclass(frozen=True)
class StumpLearner:
    """A tree of one split: the cut of one feature that explains most of the label's variance.

    Cuts lie between ``bins`` equal parts of a feature's range. Ties go to the
    smaller cut, then to the feature named first. Rows without the feature, and
    all rows if nothing can be cut, are given the mean label.
    """

    features: tuple[str, ...]
    label: str
    bins: int = 16
    labels: tuple | None = (0, 1)

    def fit(self, df: DataFrame, valid: Column | None = None) -> StumpModel:
        rows = _training(df, self.label, valid)
        y = F.col(self.label).cast("double")
        ends = [end(_finite(f)) for f in self.features for end in (F.min, F.max)]
        found = rows.agg(F.avg(y), *ends).first()
        limits = [(found[2 * i + 1], found[2 * i + 2]) for i in range(len(self.features))]
        counts, sums = self._histogram(rows, y, limits)
        gains, cuts = self._gains(counts, sums)
        best = int(np.argmax(gains))
        total = float(gains.sum())
        importances = [float(g) / total if total > 0 else 0.0 for g in gains]
        if not gains[best] > 0:
            return StumpModel(self, importances, found[0])
        cut = cuts[best]
        n, s = counts[best], sums[best]
        low, high = s[: cut + 1].sum() / n[: cut + 1].sum(), s[cut + 1 :].sum() / n[cut + 1 :].sum()
        return StumpModel(self, importances, found[0], self.features[best], limits[best], int(cut), float(low), float(high))

    def _histogram(self, rows: DataFrame, y: Column, limits: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and label sums by feature and bin; features without a range have none."""
        shape = (len(self.features), self.bins)
        counts, sums = np.zeros(shape, np.int64), np.zeros(shape)
        cells = []
        for i, f in enumerate(self.features):
            if limits[i][0] is not None and limits[i][0] < limits[i][1]:
                at = position(f, limits[i], self.bins)
                # the largest value belongs to the last bin; least() would put missing ones there too
                cells.append(F.struct(F.lit(i).alias("f"), F.when(at == self.bins, F.lit(self.bins - 1)).otherwise(at).alias("b")))
        if cells:
            long = rows.select(y.alias("y"), F.explode(F.array(*cells)).alias("e")).filter("e.b is not null")
            for f, b, n, s in long.groupBy("e.f", "e.b").agg(F.count(F.lit(1)), F.sum("y")).collect():
                counts[f, b], sums[f, b] = n, s
        return counts, sums

    def _gains(self, counts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best gain of each feature and the last bin on its left side."""
        n, s = counts.cumsum(axis=1)[:, :-1], sums.cumsum(axis=1)[:, :-1]
        all_n, all_s = counts.sum(axis=1)[:, None], sums.sum(axis=1)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = s * s / n + (all_s - s) * (all_s - s) / (all_n - n) - all_s * all_s / all_n
        gain = np.where((n > 0) & (n < all_n), gain, 0.0)
        cuts = gain.argmax(axis=1)
        return gain[np.arange(len(gain)), cuts], cuts


def position(feature: str, limits: tuple[float, float], bins: int) -> Column:
    """The bin of a value, from 0; values outside the limits lie below 0 or from ``bins`` on."""
    low, high = (F.lit(float(v)) for v in limits)
    at = (_finite(feature) - low) / (high - low) * F.lit(float(bins))
    # only the side of the limits counts outside them; a null stays one
    at = F.when(at < 0, F.lit(-1.0)).when(at > bins, F.lit(float(bins))).otherwise(at)
    return F.floor(at).cast("int")


@dataclass(frozen=True)
class StumpModel:
    learner: StumpLearner
    importances: list[float]
    overall: float | None
    feature: str | None = None
    limits: tuple[float, float] | None = None
    cut: int | None = None
    low: float | None = None
    high: float | None = None

    def score(self, df: DataFrame, name: str) -> DataFrame:
        mean = F.lit(self.overall).cast("double")
        if self.feature is None:
            return df.withColumn(name, mean)
        at = position(self.feature, self.limits, self.learner.bins)
        return df.withColumn(name, F.when(at <= self.cut, F.lit(self.low)).when(at > self.cut, F.lit(self.high)).otherwise(mean))

    def probabilities(self, df: DataFrame, name: str) -> DataFrame:
        return self.score(df, name).withColumn(name, F.array(1.0 - F.col(name), F.col(name)))


@dataclass(frozen=True)
class LeastSquaresLearner:
    """Linear least squares from centred products; importances are absolute standardised coefficients.

    Rows that lack a feature are left out of the fit and are scored with the
    feature's mean. Of features that depend on each other the solution of least
    norm is taken; constant features have no weight. With ``labels`` the score
    is a probability, cut to 0..1; with None it is a number.
    """

    features: tuple[str, ...]
    label: str
    labels: tuple | None = (0, 1)

    def fit(self, df: DataFrame, valid: Column | None = None) -> LeastSquaresModel:
        names = [f"__fw_f{i}" for i in range(len(self.features))]
        values = [_finite(f).alias(n) for f, n in zip(self.features, names)]
        rows = _training(df, self.label, valid).select(_finite(self.label).alias("__fw_y"), *values).dropna()
        names = [*names, "__fw_y"]
        means = rows.agg(*[F.avg(n) for n in names]).first()
        k = len(self.features)
        if means[0] is None:
            return LeastSquaresModel(self, [0.0] * k, [0.0] * k, [0.0] * k, None)
        away = {n: F.col(n) - F.lit(m) for n, m in zip(names, means)}
        pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
        found = rows.agg(*[F.sum(away[names[i]] * away[names[j]]) for i, j in pairs]).first()
        moments = np.zeros((k + 1, k + 1))
        for (i, j), value in zip(pairs, found):
            moments[i, j] = moments[j, i] = value
        spread = np.sqrt(np.diag(moments))
        scale = np.where(spread > 0, spread, 1.0)
        related = moments / scale[:, None] / scale
        standard = np.linalg.lstsq(related[:k, :k], related[:k, k], rcond=1e-12)[0]
        standard = np.where(spread[:k] > 0, standard, 0.0)
        weights = standard * scale[k] / scale[:k]
        return LeastSquaresModel(self, [abs(float(v)) for v in standard], [float(v) for v in weights], [float(m) for m in means[:k]], float(means[k]))


@dataclass(frozen=True)
class LeastSquaresModel:
    learner: LeastSquaresLearner
    importances: list[float]
    weights: list[float]
    means: list[float]
    overall: float | None

    def score(self, df: DataFrame, name: str) -> DataFrame:
        value = F.lit(self.overall).cast("double")
        for f, w, m in zip(self.learner.features, self.weights, self.means):
            value = value + F.coalesce(_finite(f) - F.lit(m), F.lit(0.0)) * F.lit(w)
        if self.learner.labels is not None:
            value = F.when(value < 0, F.lit(0.0)).when(value > 1, F.lit(1.0)).otherwise(value)
        return df.withColumn(name, value)

    def probabilities(self, df: DataFrame, name: str) -> DataFrame:
        return self.score(df, name).withColumn(name, F.array(1.0 - F.col(name), F.col(name)))
