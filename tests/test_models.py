"""Properties of the model flows."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Observation
from pyspark.sql import functions as F

from foldwright.operators import blend, curriculum, distill, metrics, oof, pseudo, splits
from foldwright.operators.learners import GroupMeanLearner, SparkLearner, detect_task


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    lines = []
    for i in range(400):
        x, z = rng.gauss(0, 1), rng.gauss(0, 1)
        lines.append((i, f"g{i % 20}", x, z, int(x + 0.3 * rng.gauss(0, 1) > 0), "abc"[(x > -0.5) + (x > 0.5)], 2 * x + z))
    df = spark.createDataFrame(lines, "id long, g string, x double, z double, y int, kind string, target double")
    return splits.stratified_kfold(df, "id", "y", 3).cache()


def logistic(features=("x", "z"), label="y", **options):
    return SparkLearner(LogisticRegression(maxIter=10), tuple(features), label, **options)


def test_oof_covers_every_row_once_and_predicts(data):
    run = oof.OutOfFold(logistic(), "y", n_folds=3)
    out = run.fit_predict(data, "id")
    assert out.count() == out.select("id").distinct().count() == 400
    assert metrics.auc(out, "y", "oof").first()["auc"] > 0.9
    per_fold, summary = run.scores()
    assert per_fold.count() == 3
    scores = [r["score"] for r in per_fold.collect()]
    mean = sum(scores) / 3
    assert summary.first()["mean"] == pytest.approx(mean)
    assert summary.first()["std"] == pytest.approx((sum((s - mean) ** 2 for s in scores) / 3) ** 0.5)
    assert dict(run.importances(["x", "z"]))["x"] > dict(run.importances(["x", "z"]))["z"]


def test_refit_starts_afresh(data):
    run = oof.OutOfFold(GroupMeanLearner(("g",), "y"), "y", n_folds=3)
    run.fit_predict(data, "id")
    run.fit_predict(data, "id")
    assert len(run.models) == 3
    assert run.predict(data, averaging="geometric").count() == 400
    with pytest.raises(ValueError):
        run.predict(data, averaging="nonsense")
    with pytest.raises(RuntimeError):
        oof.OutOfFold(logistic(), "y").predict(data)


def test_early_stopping_uses_held_out_rows(data):
    learner = SparkLearner(GBTClassifier(maxIter=10, maxDepth=2, seed=1), ("x", "z"), "y")
    run = oof.OutOfFold(learner, "y", n_folds=3)
    assert run.fit_predict(data, "id").count() == 400


def test_more_classes_and_regression(data):
    learner = SparkLearner(DecisionTreeClassifier(maxDepth=3), ("x", "z"), "kind", labels=("a", "b", "c"))
    run = oof.OutOfFold(learner, "kind", n_folds=3)
    out = run.fit_predict(data, "id")
    assert {len(r["oof"]) for r in out.collect()} == {3}
    assert {len(r["p"]) for r in run.predict(data, "p").collect()} == {3}
    linear = SparkLearner(LinearRegression(), ("x", "z"), "target", labels=None)
    fitted = oof.OutOfFold(linear, "target", n_folds=3, metric="rmse")
    fitted.fit_predict(data, "id")
    assert fitted.scores()[1].first()["mean"] < 0.01
    assert detect_task(data, "y") == "classification"
    assert detect_task(data, "target") == "regression"


def test_stack(data):
    base = {"a": logistic(("x",)), "b": SparkLearner(DecisionTreeClassifier(maxDepth=3), ("x", "z"), "y")}
    stack = oof.Stack(base, lambda cols: logistic(cols), "y", n_folds=3, passthrough=("z",))
    meta = stack.fit(data, "id")
    assert stack.meta_features == ["meta_a", "meta_b", "z"]
    assert meta.count() == 400
    assert metrics.auc(stack.predict(data), "y", "prediction").first()["auc"] > 0.9
    assert [n for n, _ in stack.importances()] == stack.meta_features


def test_stack_with_more_classes(data):
    base = {"t": SparkLearner(DecisionTreeClassifier(maxDepth=3), ("x", "z"), "kind", labels=("a", "b", "c"))}
    meta = lambda cols: SparkLearner(LogisticRegression(maxIter=5), tuple(cols), "kind", labels=("a", "b", "c"))
    stack = oof.Stack(base, meta, "kind", n_folds=3, n_classes=3)
    stack.fit(data, "id")
    assert stack.meta_features == ["meta_t_0", "meta_t_1", "meta_t_2"]
    assert stack.predict(data).select(F.size("prediction").alias("k")).distinct().collect()[0]["k"] == 3


def test_adversarial_validation(data):
    same, _ = oof.adversarial_validation(
        data.filter("id % 2 = 0"), data.filter("id % 2 = 1"), ["x", "z"], "id", lambda label: logistic(label=label)
    )
    moved = data.filter("id % 2 = 1").withColumn("x", F.col("x") + 5)
    other, importances = oof.adversarial_validation(
        data.filter("id % 2 = 0"), moved, ["x", "z"], "id", lambda label: logistic(label=label)
    )
    assert abs(same.first()["auc"] - 0.5) < 0.15
    assert other.first()["auc"] > 0.95 and other.first()["shifted"]
    assert max(importances, key=lambda p: p[1])[0] == "x"


def test_iterations_label_each_row_once(data):
    train = data.filter("id < 200").select("id", "x", "z", "y")
    rest = data.filter("id >= 200").select("id", "x", "z")
    _, rounds, final = pseudo.iterate(train, rest, logistic(), "y", "id", threshold=0.8, valid=train, max_iterations=3)
    assert final.count() == final.select("id").distinct().count()
    assert [r.total_size for r in rounds] == sorted(r.total_size for r in rounds)
    _, top, final = pseudo.iterate_top(train, rest, logistic(), "y", "id", threshold=0.6, sample_ratio=0.25, max_iterations=2)
    assert all(r.n_pseudo_labels <= 50 for r in top)
    assert final.count() <= 250
    _, safe, _ = pseudo.iterate_safely(train, rest, logistic(), "y", "id", threshold=0.8, valid=train, min_improvement=10.0)
    assert len(safe) == 1


def test_nothing_confident_returns_training_rows(data):
    train = data.filter("id < 200").select("id", "x", "z", "y")
    rest = data.filter("id >= 200").select("id", "x", "z")
    model = logistic().fit(train)
    out = pseudo.pseudo_label(train, rest, [model], "y", "id", threshold=1.1)
    assert out.groupBy("origin").count().collect()[0].asDict() == {"origin": "train", "count": 200}


def test_balance_rule(spark):
    lines = [(i, 0.96, 1) for i in range(9)] + [(9, 0.96, 0), (10, 0.8, 0), (11, 0.7, 0)]
    df = spark.createDataFrame(lines, "id long, confidence double, label int")
    assert pseudo.balanced_threshold(df, 0.95).count() == 11
    assert pseudo.balanced_threshold(df, 0.95, max_imbalance=10.0).count() == 10


def test_curriculum_sizes_and_self_paced(data):
    assert curriculum.stage_sizes(100, 3, 0.5) == [50, 100, 100]
    models, sizes = curriculum.train_curriculum(data, logistic(), "y", "id", ["x", "z"], n_stages=2)
    assert sizes == [200, 400] and len(models) == 2
    _, stages = curriculum.train_self_paced(data, logistic(), "y", threshold=0.2, n_stages=3)
    assert [round(t, 3) for t, _ in stages] == [0.2, 0.24, 0.288]


def test_distillation(data):
    student = SparkLearner(LogisticRegression(maxIter=10), ("x",), "class", weight="weight")
    run = distill.Distiller({"full": logistic()}, student, temperature=2.0, alpha=0.5)
    run.fit_teachers(data)
    soft = run.soft_labels(data)
    sums = soft.select(F.round(F.aggregate("soft_label", F.lit(0.0), lambda a, v: a + v), 9).alias("s")).distinct().collect()
    assert [r["s"] for r in sums] == [1.0]
    run.distill(data, "y")
    scores = {r["model"]: r["score"] for r in run.evaluate(data, "y").collect()}
    assert set(scores) == {"teacher_full", "student"}
    assert scores["student"] > 0.9


def test_soft_rows_weigh_one_per_row(spark):
    df = spark.createDataFrame([(1, [0.2, 0.8], 0)], "id long, soft_label array<double>, y int")
    out = distill.soft_rows(df, 2, label="y", alpha=0.5)
    assert sorted((r["class"], round(r["weight"], 9)) for r in out.collect()) == [(0, 0.6), (1, 0.4)]


def test_best_weights_equal_all_scores(data):
    """Bounds from few ranges are wide, from many narrow; the exact winner comes out of either."""
    wide = data.select("id", "y", F.col("x").alias("a"), F.col("z").alias("b"))
    wide = wide.withColumns({c: 1 / (1 + F.exp(-F.col(c))) for c in ("a", "b")})
    candidates = [[w / 10, 1 - w / 10] for w in range(11)]
    scores = blend.score_weights(wide, "y", ["a", "b"], candidates, "auc")
    for ranges in (4, 65_536):
        for score, (low, high) in zip(scores, blend.auc_bounds(wide, "y", ["a", "b"], candidates, ranges)):
            assert low - 1e-12 <= score <= high + 1e-12
    top = max(scores)
    assert blend.best_weights(wide, "y", ["a", "b"], candidates, "auc", 0.0) == (scores.index(top), top)
    assert blend.best_weights(wide, "y", ["a", "b"], candidates, "auc", top) is None


def test_weight_search_improves(data):
    wide = data.select("id", "y", F.col("x").alias("good"), F.col("z").alias("bad"))
    wide = wide.withColumns({c: 1 / (1 + F.exp(-F.col(c))) for c in ("good", "bad")})
    start = blend.score_weights(wide, "y", ["good", "bad"], [[0.5, 0.5]], "auc")[0]
    weights, best = blend.hill_climb(wide, "y", ["good", "bad"], step=0.1, max_iterations=40, patience=40, batch=8)
    assert best > start and sum(weights.values()) == pytest.approx(1.0)
    weights, low = blend.sweep_weights(wide, "y", ["good", "bad"], "rmse", step=0.2, smallest_step=0.1)
    first = blend.score_weights(wide, "y", ["good", "bad"], [[0.5, 0.5]], "rmse")[0]
    assert low < first and weights["good"] > weights["bad"]


def test_a_model_with_a_summary_scores_after_folds_were_cut(spark, data):
    """Counting the cells of folds must leave nothing in the session that a model's summary cannot carry to tasks."""
    rows = splits.stratified_kfold(splits.kfold(data.drop("fold"), "id", 3, seed=5).withColumnRenamed("fold", "first"), "id", "y", 3)
    model = logistic().fit(rows)
    assert model.fitted.hasSummary
    assert len(model.score(rows, "p").select("id", "p").collect()) == 400


def test_a_model_scores_in_a_session_with_an_observation(spark, data):
    """What a caller observes stays in the session; models must not take it to tasks."""
    seen = Observation()
    data.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    run = oof.OutOfFold(logistic(), "y", n_folds=3, early_stopping=False)
    assert run.fit_predict(data, "id").filter("oof is not null").count() == seen.get["n"] == 400
    scored = run.predict(data)
    assert scored.count() == 400 and all(m.fitted.hasSummary and not m.scorer.hasSummary for m in run.models)
    assert all(m.scorer.coefficients == m.fitted.coefficients and m.scorer.intercept == m.fitted.intercept for m in run.models)
