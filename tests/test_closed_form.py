"""Stumps, least squares, elimination by any learner, and mutual information of many classes against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwright.operators import select
from foldwright.operators.closed_form import LeastSquaresLearner, StumpLearner

_NONE = (None, float("nan"), float("inf"), -float("inf"))


def _rows(n=300, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.uniform(-3, 8, size=n)
    y = (b + 0.4 * a + rng.normal(size=n) > 3).astype(int)
    return [(i, float(a[i]), float(b[i]), 7.0, int(y[i])) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").repartition(5)


def _brute_stump(rows, columns, bins):
    """The best (gain, column, cut) by trying every cut of every column."""
    found = []
    for at in columns:
        known = [(r[at], r[4]) for r in rows if r[at] is not None and math.isfinite(r[at])]
        low, high = min(v for v, _ in known), max(v for v, _ in known)
        best = 0.0
        for cut in range(bins - 1):
            if low == high:
                break
            left = [y for v, y in known if min(math.floor((v - low) / (high - low) * bins), bins - 1) <= cut]
            if 0 < len(left) < len(known):
                s, t, n, m = sum(left), sum(y for _, y in known), len(left), len(known)
                best = max(best, s * s / n + (t - s) * (t - s) / (m - n) - t * t / m)
        found.append(best)
    return found


def test_stump_equals_every_cut_tried(spark):
    rows = _rows() + [(900 + i, v, v, 7.0, 1) for i, v in enumerate(_NONE)]
    model = StumpLearner(("a", "b", "c"), "y", bins=9).fit(_frame(spark, rows))
    gains = _brute_stump(rows, (1, 2, 3), 9)
    assert model.importances == pytest.approx([g / sum(gains) for g in gains])
    assert model.feature == "b"
    scored = {r["id"]: r["p"] for r in model.score(_frame(spark, rows), "p").collect()}
    low, high = model.limits
    for i, _, b, _, _ in rows[:300]:
        side = model.low if min(math.floor((b - low) / (high - low) * 9), 8) <= model.cut else model.high
        assert scored[i] == side
    assert all(scored[900 + i] == model.overall for i in range(len(_NONE)))


def test_stump_scores_values_outside_its_limits(spark):
    model = StumpLearner(("b",), "y").fit(_frame(spark, _rows()))
    far = _frame(spark, [(1, 0.0, -1e300, 0.0, 0), (2, 0.0, 1e300, 0.0, 0)])
    assert {r["id"]: r["p"] for r in model.score(far, "p").collect()} == {1: model.low, 2: model.high}


def test_stump_without_a_cut_gives_the_mean(spark):
    same = [(i, None, 2.0, 7.0, i % 4 == 0) for i in range(8)]
    same = _frame(spark, [(i, a, b, c, int(y)) for i, a, b, c, y in same])
    model = StumpLearner(("a", "b", "c"), "y").fit(same)
    assert model.importances == [0.0, 0.0, 0.0]
    assert {r["p"] for r in model.score(same, "p").collect()} == {0.25}
    assert StumpLearner(("a",), "y").fit(same.limit(0)).score(same, "p").first()["p"] is None


def test_stump_leaves_validation_and_unlabelled_rows_out(spark):
    rows = _rows(120)
    wider = [*rows, *[(500 + i, 0.0, 90.0, 7.0, 0) for i in range(40)], *[(600 + i, 0.0, -90.0, 7.0, None) for i in range(40)]]
    plain = StumpLearner(("a", "b"), "y").fit(_frame(spark, rows))
    held = StumpLearner(("a", "b"), "y").fit(_frame(spark, wider), valid=F.col("id").between(500, 599))
    assert (held.feature, held.cut, held.limits, held.importances) == (plain.feature, plain.cut, plain.limits, plain.importances)


def test_least_squares_equals_numpy_far_from_zero(spark):
    rows = [(i, a + 1e7, b, c, y) for i, a, b, c, y in _rows()]
    model = LeastSquaresLearner(("a", "b", "c"), "y", labels=None).fit(_frame(spark, rows))
    x = np.array([[r[1] - 1e7, r[2], 1.0] for r in rows])
    y = np.array([r[4] for r in rows], float)
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert model.weights[:2] == pytest.approx(want[:2].tolist(), rel=1e-6)
    assert model.weights[2] == 0.0 and model.importances[2] == 0.0
    scored = {r["id"]: r["p"] for r in model.score(_frame(spark, rows), "p").collect()}
    assert [scored[i] for i in range(len(rows))] == pytest.approx((x @ want).tolist(), abs=1e-6)


def test_least_squares_of_dependent_missing_and_no_rows(spark):
    rows = [(i, a, b, 2 * b + 1, y) for i, a, b, _, y in _rows()] + [(900 + i, v, 1.0, 3.0, 1) for i, v in enumerate(_NONE)]
    frame = _frame(spark, rows)
    model = LeastSquaresLearner(("b", "c"), "y").fit(frame)
    assert model.importances[0] == pytest.approx(model.importances[1])
    both = LeastSquaresLearner(("a", "b"), "y").fit(frame)
    scores = [r["p"] for r in both.score(frame.filter("id >= 900"), "p").collect()]
    assert len(set(scores)) == 1 and 0 <= scores[0] <= 1
    assert all(0 <= r["p"] <= 1 for r in both.score(frame, "p").collect())
    assert LeastSquaresLearner(("a", "b"), "y").fit(frame.limit(0)).score(frame, "p").first()["p"] is None


def test_elimination_asks_the_learner_again_after_each_drop(spark):
    asked = []

    def learner(features):
        asked.append(features)
        return LeastSquaresLearner(features, "y")

    kept = select.eliminate_by(_frame(spark, _rows()), ["a", "b", "c"], learner, 1)
    assert kept == ["b"]
    assert asked == [("a", "b", "c"), ("a", "b")]


def test_mutual_information_of_many_classes(spark):
    rows = [(i, float(i % 40), float((i * i) % 97), 0.0, i % 400) for i in range(4000)]
    rows += [(9000 + i, None, 5.0, None, i) for i in range(50)] + [(9500, 1.0, 1.0, 1.0, None)]
    got = {r["feature"]: r["score"] for r in select.mutual_information(_frame(spark, rows), ["a", "b", "c"], "y", n_bins=4).collect()}
    for at, name in ((1, "a"), (2, "b")):
        known = [r for r in rows if r[at] is not None]
        edges = sorted(set(np.quantile([r[at] for r in known], [0.25, 0.5, 0.75])))
        pairs = [(sum(e < r[at] for e in edges), r[4]) for r in known if r[4] is not None]
        n, left, right, both = len(pairs), {}, {}, {}
        for b, c in pairs:
            left[b], right[c], both[b, c] = left.get(b, 0) + 1, right.get(c, 0) + 1, both.get((b, c), 0) + 1
        want = sum(k / n * math.log(k * n / (left[b] * right[c])) for (b, c), k in both.items())
        assert got[name] == pytest.approx(want, abs=1e-9)
    assert got["c"] == pytest.approx(0.0)
