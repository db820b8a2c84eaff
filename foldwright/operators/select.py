"""Feature selection: univariate scores, forests, elimination, votes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.functions.scalars import bin_number
from foldwright.operators.learners import Learner
from foldwright.plans.quantiles import table_quantiles
from foldwright.session import stage


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(feature, score)``: between-class over within-class variance.

    Class counts, means and variances of all features come from one aggregate
    by class; everything after it has one row per class and feature.
    """
    known = df.filter(F.col(label).isNotNull())
    per_class = known.groupBy(label).agg(
        *[F.struct(F.count(c).alias("n"), F.avg(c).alias("m"), F.var_pop(c).alias("v")).alias(c) for c in features]
    )
    long = per_class.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("s")) for c in features])).alias("e")
    ).select("e.feature", "e.s.n", "e.s.m", "e.s.v")
    grand = long.groupBy("feature").agg(
        F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("grand"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("k"),
    )
    both = long.join(F.broadcast(grand), "feature")
    between = F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand")))
    within = F.sum(F.col("n") * F.col("v"))
    k, total = F.first("k"), F.first("total")
    return both.groupBy("feature").agg(
        F.try_divide(F.try_divide(between, k - 1), F.try_divide(within, total - k)).alias("score")
    )


def _binned(df: DataFrame, features: Sequence[str], label: str, n_bins: int) -> DataFrame:
    """Counts ``(feature, bin, class, n)`` with exact quantile bins."""
    shares = [i / n_bins for i in range(1, n_bins)]
    edges = table_quantiles(df, features, shares)
    cells = []
    for c in features:
        inner = sorted({e for e in edges[c] if e is not None})
        cells.append(F.struct(F.lit(c).alias("feature"), bin_number(c, inner).alias("bin")))
    long = df.select(F.col(label).alias("class"), F.explode(F.array(*cells)).alias("e"))
    long = long.filter(F.col("class").isNotNull() & F.col("e.bin").isNotNull())
    return long.groupBy("e.feature", "e.bin", "class").agg(F.count(F.lit(1)).alias("n"))


def mutual_information(
    df: DataFrame, features: Sequence[str], label: str, n_bins: int = 10
) -> DataFrame:
    """``(feature, score)`` in nats, from quantile bins.

    Totals by class come from one group for each feature and class, which holds
    a count for each bin, so a label of many values stays in bounded tasks.
    Totals by bin are a few rows for each feature.
    """
    counts = _binned(df, features, label, n_bins)
    bins = counts.groupBy("feature", "bin").agg(F.sum("n").cast("double").alias("by_bin"))
    bins = bins.withColumn("total", F.sum("by_bin").over(Window.partitionBy("feature")))
    classes = counts.groupBy("feature", "class").agg(F.sum("n").cast("double").alias("by_class"), F.collect_list(F.struct("bin", "n")).alias("cells"))
    cells = classes.select("feature", "by_class", F.inline("cells")).join(F.broadcast(bins), ["feature", "bin"])
    n, total = F.col("n").cast("double"), F.col("total")
    term = n / total * F.ln(n * total / (F.col("by_bin") * F.col("by_class")))
    return cells.groupBy("feature").agg(F.sum(term).alias("score"))


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(feature, score, degrees)``: Pearson's statistic of each category column against the label."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features])
    )
    long = df.select(F.col(label).alias("class"), pairs.alias("e")).filter(
        F.col("class").isNotNull() & F.col("e.value").isNotNull()
    )
    counts = long.groupBy("e.feature", "e.value", "class").agg(F.count(F.lit(1)).alias("n"))
    values = counts.groupBy("feature", "value").agg(F.sum("n").alias("row_n"))
    classes = counts.groupBy("feature", "class").agg(F.sum("n").alias("col_n"))
    totals = values.groupBy("feature").agg(F.sum("row_n").alias("total"), F.count(F.lit(1)).alias("n_values"))
    kinds = classes.groupBy("feature").agg(F.count(F.lit(1)).alias("n_classes"))
    # sum (O-E)^2/E over all cells equals total * (sum O^2/(row*col) - 1); empty cells drop out
    share = F.col("n").cast("double") * F.col("n") / (F.col("row_n").cast("double") * F.col("col_n"))
    inner = counts.join(values, ["feature", "value"]).join(classes, ["feature", "class"])
    sums = inner.groupBy("feature").agg(F.sum(share).alias("q"))
    return sums.join(totals, "feature").join(kinds, "feature").select(
        "feature",
        (F.col("total") * (F.col("q") - 1.0)).alias("score"),
        ((F.col("n_values") - 1) * (F.col("n_classes") - 1)).alias("degrees"),
    )


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int, categorical: bool = False) -> list[str]:
    """The k best features by Spark's univariate test (ANOVA, or chi-square for categories)."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="__fw_x", handleInvalid="skip").transform(df)
    selector = UnivariateFeatureSelector(
        featuresCol="__fw_x", labelCol=label, outputCol="__fw_s", selectionMode="numTopFeatures"
    )
    selector = selector.setFeatureType("categorical" if categorical else "continuous").setLabelType("categorical")
    model = selector.setSelectionThreshold(k).fit(assembled)
    return [features[i] for i in sorted(model.selectedFeatures)]


def forest_importance(
    df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, depth: int = 5, seed: int = 42
) -> DataFrame:
    """``(feature, score)`` from a random forest."""
    lines = sorted(_forest(df, features, label, n_trees, depth, seed).items())
    return df.sparkSession.createDataFrame(lines, "feature string, score double")


def _forest(df: DataFrame, features: Sequence[str], label: str, n_trees: int, depth: int, seed: int) -> dict[str, float]:
    x = VectorAssembler(inputCols=list(features), outputCol="__fw_x", handleInvalid="skip").transform(df)
    forest = RandomForestClassifier(
        featuresCol="__fw_x", labelCol=label, numTrees=n_trees, maxDepth=depth, seed=seed
    ).fit(x.select("__fw_x", label))
    return dict(zip(features, [float(v) for v in forest.featureImportances.toArray()]))


def eliminate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    n_keep: int,
    step: int | float = 1,
    n_trees: int = 50,
    depth: int = 5,
    seed: int = 42,
) -> list[str]:
    """Drop the least important features of a forest until ``n_keep`` remain.

    ``step`` below 1 is a share of the remaining features, so the number of
    forests grows with the logarithm of the width only.
    """
    def forest(rows: DataFrame, left: list[str]) -> dict[str, float]:
        return _forest(rows, left, label, n_trees, depth, seed)

    return _eliminated(df.select(label, *features), features, n_keep, step, forest)


def learner_importance(df: DataFrame, features: Sequence[str], learner: Callable[[tuple[str, ...]], Learner]) -> DataFrame:
    """``(feature, score)`` from the importances of one fit; ``learner`` builds the learner for some features."""
    lines = sorted(_importances(df, features, learner).items())
    return df.sparkSession.createDataFrame(lines, "feature string, score double")


def eliminate_by(
    df: DataFrame,
    features: Sequence[str],
    learner: Callable[[tuple[str, ...]], Learner],
    n_keep: int,
    step: int | float = 1,
) -> list[str]:
    """``eliminate`` with any learner whose models have importances; ``df`` holds what the learner reads."""
    return _eliminated(df, features, n_keep, step, lambda rows, left: _importances(rows, left, learner))


def _importances(df: DataFrame, features: Sequence[str], learner: Callable[[tuple[str, ...]], Learner]) -> dict[str, float]:
    found = getattr(learner(tuple(features)).fit(df), "importances", None)
    if found is None:
        raise ValueError("the learner's models have no importances")
    return dict(zip(features, found))


def _eliminated(
    slim: DataFrame,
    features: Sequence[str],
    n_keep: int,
    step: int | float,
    importances: Callable[[DataFrame, list[str]], dict[str, float]],
) -> list[str]:
    left = list(features)
    slim = slim.persist()
    try:
        while len(left) > n_keep:
            importance = importances(slim, left)
            drop = max(1, int(step * len(left))) if step < 1 else int(step)
            drop = min(drop, len(left) - n_keep)
            worst = set(sorted(left, key=lambda f: (importance[f], f))[:drop])
            left = [f for f in left if f not in worst]
    finally:
        slim.unpersist()
    return left


def score_table(scores: dict[str, DataFrame], kept: DataFrame | None = None) -> DataFrame:
    """Long table ``(method, feature, score)``; ``kept`` has the eliminated-to features."""
    out = None
    for method, table in scores.items():
        part = table.select(F.lit(method).alias("method"), "feature", F.col("score").cast("double"))
        out = part if out is None else out.unionByName(part)
    if kept is not None:
        out = out.unionByName(kept.select(F.lit("kept").alias("method"), "feature", F.lit(1.0).alias("score")))
    # a few lines that cost a pass each: votes and reports read them several times
    return stage(out, "feature-scores")


def votes(table: DataFrame) -> DataFrame:
    """One vote per method whose score is above its median, plus one if kept."""
    scored = table.filter(F.col("method") != "kept")
    middle = scored.groupBy("method").agg(F.percentile("score", F.lit(0.5)).alias("middle"))
    ballots = scored.join(F.broadcast(middle), "method").select(
        "feature", (F.col("score") > F.col("middle")).cast("int").alias("vote")
    )
    kept = table.filter(F.col("method") == "kept").select("feature", F.lit(1).alias("vote"))
    return ballots.unionByName(kept).groupBy("feature").agg(F.sum("vote").alias("votes"))


def top_features(ballots: DataFrame, k: int) -> DataFrame:
    return ballots.orderBy(F.desc("votes"), "feature").limit(k)


def importance_report(table: DataFrame) -> DataFrame:
    """Rank per method, kept flag and votes, one row per feature."""
    methods = [r[0] for r in table.filter(F.col("method") != "kept").select("method").distinct().orderBy("method").collect()]
    place = F.row_number().over(Window.partitionBy("method").orderBy(F.desc("score"), "feature"))
    ranked = table.withColumn("place", place)
    made = [F.max(F.when(F.col("method") == m, F.col("place"))).alias(f"{m}_rank") for m in methods]
    flags = F.max((F.col("method") == "kept").cast("int")).alias("kept")
    return ranked.groupBy("feature").agg(*made, flags).join(votes(table), "feature")
