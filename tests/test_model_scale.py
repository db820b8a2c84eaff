"""What keeps the fits and scores of the model queries in proportion to the rows."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldwright.operators import metrics, splits
from foldwright.operators.learners import SparkLearner, _between
from tests.test_models import data, logistic  # noqa: F401


def gbt():
    return GBTClassifier(maxIter=3, maxDepth=3, seed=7)


def tree():
    return DecisionTreeClassifier(maxDepth=3, seed=7)


@pytest.fixture
def coarse(spark, data):  # noqa: F811
    """4,000 rows of few values, of which Spark's trees take every limit, in any number of rows."""
    rows = data.select((F.round(F.col("x") * 2) / 2).alias("x"), (F.round(F.col("z")) / 2).alias("z"), "y", "fold")
    return rows.crossJoin(spark.range(10)).repartition(3, "fold", "x").cache()


@pytest.mark.parametrize("make", [gbt, tree])
def test_trees_fitted_on_counts_equal_those_fitted_on_rows(coarse, monkeypatch, make):
    """the estimator gets a row for each label and combination of bins, not the rows."""
    estimator = make()
    seen, fit = [], type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, df, *a: seen.append(df.count()) or fit(self, df, *a))
    learner = SparkLearner(estimator, ("x", "z"), "y")
    held = F.col("fold") == 0
    model = learner.fit(coarse, valid=held)
    assert seen and seen[0] <= 2 * 2 * coarse.select("x", "z").distinct().count() < coarse.count()
    rows = learner.vectorised(coarse.filter(~held) if make is tree else coarse.withColumn("held", held), model.fills)
    plain = estimator.copy().setFeaturesCol("__fw_x").setLabelCol("y")
    plain = fit(plain if make is tree else plain.setValidationIndicatorCol("held"), rows)
    scored = plain.transform(learner.vectorised(model.score(coarse, "p"), model.fills))
    for p, want in scored.select("p", F.get(vector_to_array("probability"), 1)).distinct().collect():
        assert p == pytest.approx(want, abs=1e-9)


def test_limits_lie_between_values_at_even_shares():
    assert _between([3.0, 1.0, 2.0, 2.0], 4) == [1.5, 2.5]
    assert _between([float(i) for i in range(8)], 4) == [1.5, 3.5, 5.5]
    assert _between([5.0] * 9, 4) == [] and _between([], 4) == []


@pytest.mark.parametrize("make", [logistic, *[lambda e=e: SparkLearner(e(), ("x", "z"), "y") for e in (gbt, tree)]])
def test_short_models_score_as_columns(data, make):  # noqa: F811
    """what the model says, without a vector for every row."""
    model = make().fit(data.withColumn("x", F.when(F.col("id") % 9 > 0, F.col("x"))))
    rows = data.withColumn("x", F.when(F.col("id") % 5 > 0, F.col("x")))
    scored = model.score(rows, "p")
    assert "UDF" not in scored._jdf.queryExecution().optimizedPlan().toString()
    both = model._raw(model.probabilities(scored, "both"), "probabilityCol").select("p", "both", vector_to_array("__fw_probabilityCol").alias("want"))
    for p, both, want in both.collect():
        assert p == pytest.approx(want[1], abs=1e-12) and both == pytest.approx(want, abs=1e-12)


def test_deep_trees_are_walked_by_the_model(data):  # noqa: F811
    model = SparkLearner(GBTClassifier(maxIter=8, maxDepth=5, seed=7), ("x", "z"), "y").fit(data)
    assert model.formula is None and model.score(data, "p").filter("p between 0 and 1").count() == 400


def test_auc_derives_each_score_once(spark, data):  # noqa: F811
    """F2: scores of a stack cost more than all that is done with them."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        calls.add(1)
        return None if x > 1.5 else round(x, 1)

    rows = data.withColumn("y", F.when(F.col("id") % 11 > 0, F.col("y"))).withColumn("p", costly("x"))
    found = metrics.auc(rows, "y", "p").first()
    pairs = [(r["y"], round(r["x"], 1)) for r in data.collect() if r["id"] % 11 and r["x"] <= 1.5]
    pos, neg = ([s for y, s in pairs if y == k] for k in (1, 0))
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert found["auc"] == pytest.approx(want) and (found["n_pos"], found["n_neg"]) == (len(pos), len(neg))
    assert calls.value == 400


def test_group_folds_join_no_column_that_is_not_asked_for(spark):
    """rows without a group are dealt by a hash of all columns, which is known before the join."""
    rows = spark.createDataFrame([(i % 40 if i % 7 else None, i, f"t{i}") for i in range(400)], "g long, id long, note string")
    placed = splits.group_kfold(rows, "g", 3)
    plan = placed.select("g", "id", "fold")._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    assert "note" not in plan.left().output().toString()
    want = {r["id"]: r["f"] for r in rows.select("id", F.pmod(F.xxhash64("g", "id", "note"), F.lit(3)).alias("f")).collect()}
    got = placed.filter("g is null").collect()
    assert len(got) == 58 and all(r["fold"] == want[r["id"]] for r in got)
