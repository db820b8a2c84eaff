"""Model data flows: out-of-fold, stacking, pseudo-labels, curricula, distillation, files."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from foldwright.catalog.registry import FOLDED, ORDERS, orders, query, rounded
from foldwright.catalog.scores import MODELS, SCORED, auc_sql, scored
from foldwright.functions import scalars, vectors
from foldwright.operators import curriculum, distill, metrics, oof, pipeline, pseudo, splits
from foldwright.operators.learners import GroupMeanLearner, GroupShareLearner, RowMeanLearner, SparkLearner
from foldwright.session import scratch_path
from foldwright.sources import sinks
from foldwright.sources.tables import read_csv, read_parquet, table

_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_KEY = "o_orderkey"


def _logistic(features, label, **options):
    return SparkLearner(LogisticRegression(maxIter=5), tuple(features), label, **options)


def _tree(features, label, **options):
    return SparkLearner(DecisionTreeClassifier(maxDepth=3, seed=7), tuple(features), label, **options)


def _scored_folds(spark, d, k=3):
    """Scored lines with group folds: lines of one order stay together."""
    return splits.group_kfold(scored(spark, d), "l_orderkey", k).select(*_IDS, "y", *MODELS, splits.FOLD)


# ------------------------------------------------------- out-of-fold, stacking

_MEAN_OOF = f"""{FOLDED}, g AS (SELECT k AS fold, avg(y) AS g FROM folded, range(5) r(k) WHERE fold <> k GROUP BY k),
  c AS (SELECT o_custkey, k AS fold, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM folded JOIN
        (SELECT fold AS k, g FROM g) gg ON folded.fold <> gg.k GROUP BY 1, 2),
  o AS (SELECT o_orderkey, y, folded.fold, coalesce(c.v, g.g) AS oof FROM folded JOIN g ON g.fold = folded.fold
        LEFT JOIN c ON c.o_custkey = folded.o_custkey AND c.fold = folded.fold)"""


def _order_folds(spark, d):
    return splits.stratified_kfold(orders(spark, d).select(_KEY, "o_custkey", "o_orderpriority", "y"), _KEY, "y")


@query("m1_oof_group_mean", f"WITH {_MEAN_OOF} SELECT o_orderkey, y, fold, round(oof, 6) AS oof FROM o")
def m1_oof_group_mean(spark, d):
    run = oof.OutOfFold(GroupMeanLearner(("o_custkey",), "y"), "y")
    return rounded(run.fit_predict(_order_folds(spark, d), _KEY))


@query("v5_learner_fold_scores", f"WITH {_MEAN_OOF} SELECT fold, round(auc, 6) AS score FROM {auc_sql('(SELECT y, fold, round(oof, 12) AS oof FROM o) o', 'oof', 'fold')}")
def v5_learner_fold_scores(spark, d):
    run = oof.OutOfFold(GroupMeanLearner(("o_custkey",), "y"), "y")
    run.fit_predict(_order_folds(spark, d), _KEY)
    run.predictions = run.predictions.withColumn("oof", F.round("oof", 12))
    return rounded(run.scores(n_classes=2)[0])


@query(
    "m2_fold_model_mean",
    f"""WITH {_MEAN_OOF}, e AS (SELECT c_custkey, g.fold, coalesce(c.v, g.g) AS v FROM customer CROSS JOIN g
          LEFT JOIN c ON c.o_custkey = c_custkey AND c.fold = g.fold)
    SELECT c_custkey, round(avg(v), 6) AS prediction FROM e GROUP BY 1""",
)
def m2_fold_model_mean(spark, d):
    run = oof.OutOfFold(GroupMeanLearner(("o_custkey",), "y"), "y")
    run.fit_predict(_order_folds(spark, d), _KEY)
    people = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("o_custkey"))
    return rounded(run.predict(people).select("c_custkey", "prediction"))


@query("m1_oof_early_stopping")
def m1_oof_early_stopping(spark, d):
    """Boosted trees stopped on the held-out fold; per-fold AUC."""
    learner = SparkLearner(GBTClassifier(maxIter=4, maxDepth=3, seed=7), tuple(MODELS), "y")
    run = oof.OutOfFold(learner, "y", n_folds=3)
    run.fit_predict(_scored_folds(spark, d), _IDS)
    return rounded(run.scores(n_classes=2)[0])


@query("m3_fold_importance")
def m3_fold_importance(spark, d):
    run = oof.OutOfFold(_logistic(MODELS, "y"), "y", n_folds=3)
    run.fit_predict(_scored_folds(spark, d), _IDS)
    return rounded(spark.createDataFrame(run.importances(MODELS), "feature string, importance double"))


def _stack(spark, d):
    base = {"logistic": _logistic(MODELS, "y"), "tree": _tree(MODELS, "y")}
    stack = oof.Stack(base, lambda cols: _logistic(cols, "y"), "y", n_folds=3, passthrough=("m_line",))
    return stack, stack.fit(_scored_folds(spark, d), _IDS)


@query("m4_stack_meta_scores")
def m4_stack_meta_scores(spark, d):
    """AUC of every meta feature on all line items."""
    _, meta = _stack(spark, d)
    names = ["meta_logistic", "meta_tree"]
    return rounded(metrics.auc(oof.long_predictions(meta, _IDS, names, ["y"]), "y", "pred", ["model"]))


@query("m5_stack_predict")
def m5_stack_predict(spark, d):
    stack, _ = _stack(spark, d)
    return rounded(metrics.auc(stack.predict(scored(spark, d)), "y", "prediction"))


@query(
    "m4_meta_pivot",
    f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(m_quantity, 6) AS meta_m_quantity, round(m_tax, 6) AS meta_m_tax FROM t",
)
def m4_meta_pivot(spark, d):
    """Long predictions back to one column per model."""
    keyed = scored(spark, d).withColumn("price_key", F.col("price").cast("string"))
    ids = [*_IDS, "price_key", "m_discount", "y", "flag", "m_line"]
    long = oof.long_predictions(keyed, ids, ["m_quantity", "m_tax"])
    wide = oof.wide_predictions(long, ids, ["m_quantity", "m_tax"])
    return rounded(wide.select(*_IDS, "meta_m_quantity", "meta_m_tax"))


@query("m28_adversarial_validation")
def m28_adversarial_validation(spark, d):
    rows = table(spark, d, "orders").withColumn("month", F.month("o_orderdate"))
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    found, _ = oof.adversarial_validation(
        rows.filter(early), rows.filter(~early), ["o_totalprice", "month"], _KEY,
        lambda label: _logistic(["o_totalprice", "month"], label),
    )
    return rounded(found)


@query(
    "e11_feature_vectors",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer),
    v AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS k FROM customer GROUP BY 1)
    SELECT c_custkey, CAST(i AS INTEGER) AS position, CASE WHEN i = 0 THEN round((c_acctbal - m) / sd, 6) ELSE CAST(k = i AS INTEGER) END AS x
    FROM customer JOIN v USING (c_mktsegment) CROSS JOIN s CROSS JOIN range(6) r(i)""",
)
def e11_feature_vectors(spark, d):
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    model = pipeline.build(["c_acctbal"], ["c_mktsegment"]).fit(rows)
    out = pipeline.transform(model, rows)
    return rounded(out.select("c_custkey", F.posexplode(vector_to_array("features")).alias("position", "x")))


# ------------------------------------------------------------- vector columns

#: Ten logits per embedding: 8 times the sum of every tenth element, the first of them at ``offset``.
def _logits_sql(offset: int = 0) -> str:
    return f"(SELECT vec_id, label, CAST(i AS INTEGER) AS i, 8 * sum(CAST(embedding[j + 1] AS DOUBLE) ORDER BY j) AS z FROM embeddings, range(10) r(i), range(64) q(j) WHERE j % 10 = (i + {offset}) % 10 GROUP BY ALL)"


def _logits(offset: int = 0):
    places = [[j for j in range(64) if j % 10 == (i + offset) % 10] for i in range(10)]
    elements = lambda at: F.transform(F.array(*map(F.lit, at)), lambda j: F.get("embedding", j).cast("double"))
    return F.array(*[8 * F.aggregate(elements(at), F.lit(0.0), lambda s, x: s + x) for at in places])


#: Ten class probabilities per embedding.
_PROBS = f"""s AS (SELECT vec_id, label, i, exp(z) AS e FROM {_logits_sql()}),
  p AS (SELECT vec_id, label, i, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM s)"""


def class_probs(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", _logits().alias("logits"), vectors.softmax(_logits()).alias("p"))


def _long(df, col, name="p"):
    return rounded(df.select("vec_id", F.posexplode(col).alias("i", name)))


_SCALED = """z AS (SELECT vec_id, label, i, ln(p + 1e-8) / 3 AS z FROM p),
  q AS (SELECT vec_id, label, i, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id) AS q FROM z)"""


@query("f5_temperature_scale", f"WITH {_PROBS}, {_SCALED} SELECT vec_id, i, round(q, 6) AS p FROM q")
def f5_temperature_scale(spark, d):
    return _long(class_probs(spark, d), vectors.temperature_scale(F.col("p"), 3.0))


@query(
    "f6_power_scale",
    f"WITH {_PROBS} SELECT vec_id, i, round(pow(p, 0.5) / sum(pow(p, 0.5)) OVER (PARTITION BY vec_id), 6) AS p FROM p",
)
def f6_power_scale(spark, d):
    return _long(class_probs(spark, d), vectors.power_scale(F.col("p"), 2.0))


@query(
    "f7_one_hot_label",
    "SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(label = i AS INTEGER)::DOUBLE AS p FROM embeddings, range(10) r(i)",
)
def f7_one_hot_label(spark, d):
    return _long(table(spark, d, "embeddings"), vectors.one_hot(F.col("label"), 10))


@query("f14_entropy", f"WITH {_PROBS} SELECT vec_id, round(sum(-p * ln(p + 1e-10)), 6) AS entropy FROM p GROUP BY 1")
def f14_entropy(spark, d):
    return rounded(class_probs(spark, d).select("vec_id", vectors.entropy(F.col("p")).alias("entropy")))


@query(
    "p11_argmax_label",
    f"""WITH {_PROBS} SELECT vec_id, round(max(p), 6) AS confidence, CAST(arg_max(i, p) AS INTEGER) AS position,
        'class' || arg_max(i, p) AS label FROM p GROUP BY 1""",
)
def p11_argmax_label(spark, d):
    names = [f"class{k}" for k in range(10)]
    p = F.col("p")
    return rounded(
        class_probs(spark, d).select(
            "vec_id", vectors.confidence(p).alias("confidence"), vectors.argmax(p).alias("position"),
            vectors.argmax_label(p, names).alias("label"),
        )
    )


@query("p9_confidence_mask", f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, m_quantity AS confidence FROM t WHERE m_quantity >= 0.9")
def p9_confidence_mask(spark, d):
    return pseudo.confident(scored(spark, d).select(*_IDS, F.col("m_quantity").alias("confidence")), 0.9)


@query("p10_decision", f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(m_quantity > 0.5 AS INTEGER) AS guess FROM t")
def p10_decision(spark, d):
    return scored(spark, d).select(*_IDS, scalars.decision(F.col("m_quantity")).alias("guess"))


@query(
    "p12_min_max",
    """SELECT o_orderkey, round((o_totalprice - (SELECT min(o_totalprice) FROM orders))
       / ((SELECT max(o_totalprice) - min(o_totalprice) FROM orders) + 1e-8), 6) AS scaled FROM orders""",
)
def p12_min_max(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_totalprice")
    return rounded(pseudo.min_max_scaled(rows, "o_totalprice", "scaled").select(_KEY, "scaled"))


@query("p13_binary_confidence", f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(greatest(m_quantity, 1 - m_quantity), 6) AS confidence FROM t")
def p13_binary_confidence(spark, d):
    return rounded(scored(spark, d).select(*_IDS, vectors.binary_confidence(F.col("m_quantity")).alias("confidence")))


def _guessed(spark, d):
    p = F.col("m_quantity") * F.col("m_quantity")
    return scored(spark, d).select(*_IDS, vectors.binary_confidence(p).alias("confidence"), scalars.decision(p).alias("label"))


_GUESSED = f"""{SCORED}, u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  greatest(m_quantity * m_quantity, 1 - m_quantity * m_quantity) AS confidence, CAST(m_quantity * m_quantity > 0.5 AS INTEGER) AS label FROM t)"""


@query(
    "p15_balanced_threshold",
    f"""WITH {_GUESSED}, c AS (SELECT label, count(*) AS n FROM u WHERE confidence >= 0.95 GROUP BY 1),
    h AS (SELECT CASE WHEN count(*) = 2 AND max(n) / (min(n) + 1) > 1.5 THEN 0.95 * 0.8 ELSE 0.95 END AS t FROM c)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label FROM u, h WHERE confidence >= t""",
)
def p15_balanced_threshold(spark, d):
    return pseudo.balanced_threshold(_guessed(spark, d), 0.95, 1.5).drop("confidence")


@query(
    "t3_top_confident",
    """SELECT event_id, value AS confidence FROM events ORDER BY value DESC, event_id
       LIMIT (SELECT count(*) // 10 FROM events)""",
)
def t3_top_confident(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("value").alias("confidence"))
    return pseudo.top_confident(rows, "event_id", rows.count() // 10)


_CENTRE = """m AS (SELECT avg(o_totalprice) AS a, stddev_pop(o_totalprice) AS sa, avg(month(o_orderdate)) AS b,
    stddev_pop(month(o_orderdate)) AS sb FROM base),
  z AS (SELECT o_orderkey, y, (o_totalprice - a) / sa AS u, (month(o_orderdate) - b) / sb AS v FROM base, m),
  c AS (SELECT y, avg(u) AS cu, avg(v) AS cv FROM z GROUP BY 1),
  w AS (SELECT o_orderkey, round(sqrt((u - cu) * (u - cu) + (v - cv) * (v - cv)), 6) AS difficulty FROM z JOIN c USING (y))"""


def _distances(spark, d):
    rows = orders(spark, d).select(_KEY, "y", "o_totalprice", F.month("o_orderdate").alias("month"))
    out = curriculum.centroid_distance(rows, "y", ["o_totalprice", "month"])
    return rounded(out.select(_KEY, "difficulty"))


@query("f15_centroid_distance", f"WITH {ORDERS}, {_CENTRE} SELECT * FROM w")
def f15_centroid_distance(spark, d):
    return _distances(spark, d)


@query(
    "t4_easiest_prefix",
    f"WITH {ORDERS}, {_CENTRE} SELECT * FROM w QUALIFY row_number() OVER (ORDER BY difficulty, o_orderkey) <= count(*) OVER () // 2",
)
def t4_easiest_prefix(spark, d):
    rows = _distances(spark, d)
    return curriculum.easiest(rows, _KEY, rows.count() // 2)


# ------------------------------------------------------------- pseudo-labels


def _documents(spark, d):
    """Labelled and unlabelled documents with simple whole-text features; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    n = F.coalesce("n_chars", F.length(text))
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.ln(n + 1.0).alias("log_chars"),
        (F.size(F.split(text, " ")) / (n + 1.0)).alias("word_share"),
        (F.size(F.split(text, "\n")) / (n + 1.0)).alias("line_share"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / (n + 1.0)).alias("digit_share"),
    )
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("y"))
    return docs.join(labels, "doc_id", "inner"), docs.join(labels, "doc_id", "left_anti")


_TEXT = ["log_chars", "word_share", "line_share", "digit_share"]


def _doc_learner(**options):
    return SparkLearner(LogisticRegression(maxIter=10, regParam=0.01), tuple(_TEXT), "y", **options)


def _per_origin(df, label="y"):
    return df.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("share"))


@query(
    "u1_append_rows",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, 'train' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
       UNION ALL SELECT o_orderkey, CAST(o_totalprice > 200000 AS INTEGER), 'pseudo' FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""",
)
def u1_append_rows(spark, d):
    rows = orders(spark, d)
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    extra = rows.filter(~early).select(_KEY, (F.col("o_totalprice") > 200000).cast("int").alias("y"))
    return pseudo.append_rows(rows.filter(early).select(_KEY, "y"), extra, "y")


@query(
    "u2_append_soft",
    f"""WITH {_PROBS} SELECT vec_id, CAST(i AS INTEGER) AS i, CAST(label = i AS INTEGER)::DOUBLE AS p, 'train' AS origin FROM embeddings, range(10) r(i) WHERE label < 5
        UNION ALL SELECT vec_id, i, round(p, 6), 'pseudo' FROM p WHERE label >= 5""",
)
def u2_append_soft(spark, d):
    rows = class_probs(spark, d)
    soft = rows.filter("label >= 5").withColumnRenamed("p", "soft_label")
    out = pseudo.append_soft(rows.filter("label < 5"), soft, "label", 10, ["vec_id"])
    return rounded(out.select("vec_id", F.posexplode("soft_label").alias("i", "p"), "origin"))


@query("m14_pseudo_label")
def m14_pseudo_label(spark, d):
    labelled, rest = _documents(spark, d)
    run = oof.OutOfFold(_doc_learner(), "y", n_folds=3, early_stopping=False)
    run.fit_predict(splits.stratified_kfold(labelled, "doc_id", "y", 3), "doc_id")
    return _per_origin(pseudo.pseudo_label(labelled, rest, run.models, "y", "doc_id", threshold=0.8))


@query("m15_iterative_pseudo_label")
def m15_iterative_pseudo_label(spark, d):
    labelled, rest = _documents(spark, d)
    parts = splits.holdout(labelled, "doc_id", "y", 0.25)
    train, valid = (parts.filter(F.col("role") == r).drop("role") for r in ("train", "valid"))
    _, rounds, _ = pseudo.iterate(train, rest, _doc_learner(), "y", "doc_id", threshold=0.8, valid=valid, max_iterations=2)
    return rounded(pseudo.history_table(spark, rounds).drop("mean_confidence"))


@query(
    "m16_confidence_stats",
    f"""WITH {_PROBS}, c AS (SELECT vec_id, max(p) AS c FROM p GROUP BY 1)
        SELECT round(avg(c), 6) AS mean, round(stddev_pop(c), 6) AS std, round(min(c), 6) AS min, round(max(c), 6) AS max FROM c""",
)
def m16_confidence_stats(spark, d):
    rows = class_probs(spark, d).withColumn("confidence", vectors.confidence(F.col("p")))
    return rounded(pseudo.confidence_stats(rows))


@query("m17_soft_pseudo_label")
def m17_soft_pseudo_label(spark, d):
    labelled, rest = _documents(spark, d)
    model = _doc_learner().fit(labelled)
    out = pseudo.soft_pseudo_label(labelled, rest, model, "y", "doc_id", 2, ["doc_id"], 2.0, 0.5)
    return _per_origin(out.withColumn("y", F.element_at("soft_label", 2)))


@query("m18_top_pseudo_label")
def m18_top_pseudo_label(spark, d):
    labelled, rest = _documents(spark, d)
    _, rounds, _ = pseudo.iterate_top(labelled, rest, _doc_learner(), "y", "doc_id", threshold=0.8, sample_ratio=0.3, max_iterations=2)
    return rounded(pseudo.history_table(spark, rounds).drop("score"))


@query("m19_safe_pseudo_label")
def m19_safe_pseudo_label(spark, d):
    labelled, rest = _documents(spark, d)
    parts = splits.holdout(labelled, "doc_id", "y", 0.25)
    train, valid = (parts.filter(F.col("role") == r).drop("role") for r in ("train", "valid"))
    _, rounds, _ = pseudo.iterate_safely(train, rest, _doc_learner(), "y", "doc_id", threshold=0.8, valid=valid, max_iterations=2)
    return rounded(pseudo.history_table(spark, rounds).drop("mean_confidence"))


@query("m20_curriculum")
def m20_curriculum(spark, d):
    labelled, _ = _documents(spark, d)
    models, sizes = curriculum.train_curriculum(labelled, _doc_learner(), "y", "doc_id", _TEXT, n_stages=2)
    out = labelled
    for i, model in enumerate(models):
        out = model.score(out, f"stage{i}")
    long = oof.long_predictions(out, "doc_id", [f"stage{i}" for i in range(len(models))], ["y"])
    sized = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.substring("model", 6, 1).cast("int") + 1)
    return rounded(metrics.auc(long, "y", "pred", ["model"]).withColumn("stage_size", sized))


@query("m21_self_paced")
def m21_self_paced(spark, d):
    labelled, _ = _documents(spark, d)
    _, stages = curriculum.train_self_paced(labelled, _doc_learner(), "y", threshold=0.3, n_stages=2, valid=labelled)
    return spark.createDataFrame([(i, *s) for i, s in enumerate(stages)], "stage int, threshold double, n_rows long")


# --------------------------------------------------------------- distillation


def _two_teachers(spark, d):
    return table(spark, d, "embeddings").select(
        "vec_id", "label", vectors.softmax(_logits()).alias("a"), vectors.softmax(_logits(3)).alias("b")
    )


@query(
    "m22_teacher_mean",
    f"""WITH s AS (SELECT vec_id, 0 AS t, i, exp(z) AS e FROM {_logits_sql()} UNION ALL SELECT vec_id, 1, i, exp(z) FROM {_logits_sql(3)}),
    p AS (SELECT vec_id, t, i, ln(e / sum(e) OVER (PARTITION BY vec_id, t) + 1e-8) / 3 AS z FROM s),
    q AS (SELECT vec_id, t, i, exp(z) / sum(exp(z)) OVER (PARTITION BY vec_id, t) AS q FROM p)
    SELECT vec_id, i, round(sum(q * CASE WHEN t = 0 THEN 0.75 ELSE 0.25 END), 6) AS p FROM q GROUP BY 1, 2""",
)
def m22_teacher_mean(spark, d):
    out = distill.teacher_mean(_two_teachers(spark, d), ["a", "b"], 3.0, {"a": 3.0, "b": 1.0})
    return _long(out, "soft_label")


@query(
    "m23_soft_rows",
    f"""WITH {_PROBS} SELECT vec_id, i AS class, round(0.7 * p + 0.3 * CAST(label = i AS INTEGER), 6) AS weight FROM p""",
)
def m23_soft_rows(spark, d):
    rows = distill.soft_rows(class_probs(spark, d).withColumnRenamed("p", "soft_label"), 10, label="label", alpha=0.7)
    return rounded(rows.select("vec_id", "class", "weight"))


def _distiller():
    student = SparkLearner(LogisticRegression(maxIter=5), tuple(MODELS), "class", weight="weight")
    return distill.Distiller({"logistic": _logistic(MODELS, "y"), "tree": _tree(MODELS, "y")}, student, alpha=0.7)


@query("m24_distilled_scores")
def m24_distilled_scores(spark, d):
    """AUC of two teachers and the student fitted on their soft labels."""
    rows = scored(spark, d)
    run = _distiller()
    run.fit_teachers(rows)
    run.distill(rows, "y")
    return rounded(run.evaluate(rows, "y"))


@query("m25_distillation_dataset")
def m25_distillation_dataset(spark, d):
    labelled, rest = _documents(spark, d)
    teachers = [_doc_learner().fit(labelled)]
    out = distill.distillation_dataset(labelled, rest, teachers, "y", "doc_id", 2, ["doc_id"], 3.0, 0.5)
    return _per_origin(out.withColumn("y", F.element_at("soft_label", 2)))


_TEMPS = (1, 2, 3, 5, 10)


@query(
    "m26_temperature_analysis",
    f"""WITH {_PROBS}, t AS (SELECT unnest([1.0, 2.0, 3.0, 5.0, 10.0])::DOUBLE AS t),
    q AS (SELECT t, vec_id, label, i, pow(p, 1 / t) / sum(pow(p, 1 / t)) OVER (PARTITION BY t, vec_id) AS q FROM p, t),
    r AS (SELECT t, vec_id, sum(-q * ln(q + 1e-10)) AS h FROM q GROUP BY 1, 2),
    a AS (SELECT avg(CAST(arg = label AS DOUBLE)) AS a FROM (SELECT vec_id, any_value(label) AS label, arg_max(i, p) AS arg FROM p GROUP BY 1))
    SELECT t AS temperature, round(avg(h), 6) AS entropy, round(any_value(a), 6) AS accuracy FROM r, a GROUP BY 1""",
)
def m26_temperature_analysis(spark, d):
    return rounded(distill.temperature_analysis(class_probs(spark, d), "p", "label", _TEMPS))


@query(
    "m27_distillation_loss",
    f"""WITH s AS (SELECT a.vec_id, a.label, a.i, a.z AS a, b.z AS b FROM {_logits_sql()} a JOIN {_logits_sql(3)} b USING (vec_id, i)),
    q AS (SELECT vec_id, label, i, exp(a) / sum(exp(a)) OVER w AS teacher, exp(b / 2) / sum(exp(b / 2)) OVER w AS soft,
                 exp(b) / sum(exp(b)) OVER w AS hard FROM s WINDOW w AS (PARTITION BY vec_id)),
    l AS (SELECT vec_id, label, 0.5 * 4 * sum(teacher * (ln(teacher) - ln(soft + 1e-12))) - 0.5 * sum(CASE WHEN i = label THEN ln(hard) ELSE 0 END) AS loss
          FROM q GROUP BY 1, 2)
    SELECT label, round(avg(loss), 6) AS loss FROM l GROUP BY 1""",
)
def m27_distillation_loss(spark, d):
    loss = distill.distillation_loss(_logits(3), vectors.softmax(_logits()), 2.0, 0.5, F.col("label"))
    rows = table(spark, d, "embeddings").select("label", loss.alias("loss"))
    return rounded(rows.groupBy("label").agg(F.avg("loss").alias("loss")))


# ---------------------------------------------------------------------- files


@query("s1_csv_scan", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def s1_csv_scan(spark, d):
    path = scratch_path(spark, "csv")
    cols = [_KEY, "o_custkey", "o_totalprice", "o_orderpriority"]
    table(spark, d, "orders").select(*cols).write.option("header", "true").csv(path)
    return read_csv(spark, path, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string")


@query(
    "s3_parquet_scan",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 200000 GROUP BY 1",
)
def s3_parquet_scan(spark, d):
    rows = read_parquet(spark, f"{d}/orders.parquet", nan_as_null=False).filter("o_totalprice > 200000")
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s4_submission", "SELECT o_orderkey, printf('%.6f', o_totalprice / 700001) AS prediction FROM orders")
def s4_submission(spark, d):
    path = scratch_path(spark, "submission")
    rows = table(spark, d, "orders").select(_KEY, (F.col("o_totalprice") / 700001).alias("prediction"))
    sinks.write_submission(rows, path, _KEY, "prediction", compression="gzip")
    return spark.read.schema("o_orderkey long, prediction string").option("header", "true").csv(path)


@query(
    "s5_saved_predictions",
    f"WITH {FOLDED} SELECT o_orderkey, 'price' AS model, fold, round(o_totalprice / 700001, 6) AS pred FROM folded",
)
def s5_saved_predictions(spark, d):
    path = scratch_path(spark, "predictions")
    rows = splits.stratified_kfold(orders(spark, d), _KEY, "y")
    pred = F.round(F.col("o_totalprice") / 700001, 6).alias("pred")
    sinks.save_predictions(rows.select(_KEY, F.lit("price").alias("model"), "fold", pred), path)
    return sinks.load_predictions(spark, path, ["price"]).select(_KEY, "model", "fold", "pred")


@query(
    "s6_saved_state",
    f"""WITH {ORDERS}, g AS (SELECT avg(y) AS g FROM base), a AS (SELECT o_custkey, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM base, g GROUP BY 1)
    SELECT o_orderkey, round(v, 6) AS o_custkey_target_enc, '1.0.0' AS version, 'y' AS target FROM base JOIN a USING (o_custkey)""",
)
def s6_saved_state(spark, d):
    from foldwright.operators import encode

    rows = orders(spark, d).select(_KEY, "o_custkey", "y")
    path = scratch_path(spark, "state")
    sinks.save_state(spark, path, {"target": encode.fit_target(rows, "o_custkey", "y")}, "1.0.0", {"target": "y"})
    tables, version, metadata = sinks.load_state(spark, path)
    out = encode.apply_target(rows, tables["target"], "o_custkey", keep=[_KEY])
    return rounded(out.withColumns({"version": F.lit(version), "target": F.lit(metadata["target"])}))


@query(
    "s7_prediction_log",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(avg(abs(value / 500 - CAST(event_type = 'error' AS DOUBLE))), 6) AS mae
       FROM events GROUP BY 1""",
)
def s7_prediction_log(spark, d):
    from foldwright.catalog.checks import prediction_log

    path = scratch_path(spark, "log")
    sinks.append_log(prediction_log(spark, d), path)
    log = spark.read.parquet(path)
    return rounded(log.groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.avg("error").alias("mae")))


@query(
    "p1_encoded_only",
    f"""WITH {ORDERS}, g AS (SELECT avg(y) AS g FROM base), a AS (SELECT o_orderpriority, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM base, g GROUP BY 1)
    SELECT o_orderkey, round(v, 6) AS o_orderpriority_target_enc FROM base JOIN a USING (o_orderpriority)""",
)
def p1_encoded_only(spark, d):
    from foldwright.operators import encode

    rows = orders(spark, d)
    return rounded(encode.apply_target(rows, encode.fit_target(rows, "o_orderpriority", "y"), "o_orderpriority", keep=[_KEY]))


# ----------------------------- the same flows with a learner that SQL can express


def _group_learner(*keys):
    return GroupMeanLearner(keys, "y")


def _labelled_groups(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").alias("y"))
    return docs.join(labels, "doc_id"), docs.join(labels, "doc_id", "left_anti")


_DOCS = """l AS (SELECT doc_id, lang, source, quality AS y FROM documents JOIN labels USING (doc_id)),
  u AS (SELECT doc_id, lang, source FROM documents ANTI JOIN labels USING (doc_id)),
  g AS (SELECT avg(y) AS g FROM l),
  m AS (SELECT lang, source, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM l, g GROUP BY 1, 2),
  p AS (SELECT doc_id, coalesce(v, g) AS p FROM u CROSS JOIN g LEFT JOIN m USING (lang, source)),
  c AS (SELECT doc_id, p, greatest(1 - p, p) AS confidence, CAST(p > 1 - p AS INTEGER) AS y FROM p)"""


@query(
    "m4_stack_meta_table",
    f"""WITH {FOLDED}, g AS (SELECT k AS fold, avg(y) AS g FROM folded, range(5) r(k) WHERE fold <> k GROUP BY k),
    a AS (SELECT o_custkey, g.fold, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM folded f JOIN g ON f.fold <> g.fold GROUP BY 1, 2),
    b AS (SELECT o_orderpriority, g.fold, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM folded f JOIN g ON f.fold <> g.fold GROUP BY 1, 2)
    SELECT o_orderkey, fold, round(coalesce(a.v, g), 6) AS meta_customer, round(coalesce(b.v, g), 6) AS meta_priority
    FROM folded JOIN g USING (fold) LEFT JOIN a USING (o_custkey, fold) LEFT JOIN b USING (o_orderpriority, fold)""",
)
def m4_stack_meta_table(spark, d):
    base = {"customer": _group_learner("o_custkey"), "priority": _group_learner("o_orderpriority")}
    stack = oof.Stack(base, lambda cols: _logistic(cols, "y"), "y")
    return rounded(stack.fit(_order_folds(spark, d), _KEY).select(_KEY, "fold", "meta_customer", "meta_priority"))


@query(
    "m15_iterate_group_mean",
    f"""WITH {_DOCS}, s AS (SELECT doc_id, y FROM c WHERE confidence >= 0.72 QUALIFY
      row_number() OVER (ORDER BY md5(concat_ws('_', '42', CAST(doc_id AS VARCHAR)))) <= floor(count(*) OVER () * 0.5))
    SELECT doc_id, y FROM l UNION ALL SELECT doc_id, y FROM s""",
)
def m15_iterate_group_mean(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    _, _, final = pseudo.iterate(
        labelled, rest, _group_learner("lang", "source"), "y", "doc_id", threshold=0.72, max_iterations=1
    )
    return final.select("doc_id", "y")


@query(
    "m17_soft_group_mean",
    f"""WITH {_DOCS}, s AS (SELECT doc_id, p FROM p QUALIFY row_number() OVER
      (ORDER BY md5(concat_ws('_', '42', CAST(doc_id AS VARCHAR)))) <= floor(count(*) OVER () * 0.5))
    SELECT doc_id, y::DOUBLE AS p, 'train' AS origin FROM l
    UNION ALL SELECT doc_id, round(sqrt(p + 1e-8) / (sqrt(p + 1e-8) + sqrt(1 - p + 1e-8)), 6), 'pseudo' FROM s""",
)
def m17_soft_group_mean(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    model = _group_learner("lang", "source").fit(labelled)
    out = pseudo.soft_pseudo_label(labelled, rest, model, "y", "doc_id", 2, ["doc_id"], 2.0, 0.5)
    return rounded(out.select("doc_id", F.element_at("soft_label", 2).alias("p"), "origin"))


@query(
    "m18_top_group_mean",
    f"""WITH {_DOCS}, s AS (SELECT doc_id, y FROM c WHERE confidence >= 0.6 ORDER BY round(confidence, 9) DESC, doc_id
      LIMIT (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM u))
    SELECT doc_id, y FROM l UNION ALL SELECT doc_id, y FROM s""",
)
def m18_top_group_mean(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    _, _, final = pseudo.iterate_top(
        labelled, rest, _group_learner("lang", "source"), "y", "doc_id", threshold=0.6, sample_ratio=0.2, max_iterations=1
    )
    return final.select("doc_id", "y")


@query(
    "m19_safe_group_mean",
    f"""WITH {_DOCS}, n AS (SELECT y, count(*) AS n FROM c WHERE confidence >= 0.8 GROUP BY 1),
    t AS (SELECT CASE WHEN count(*) = 2 AND max(n) / (min(n) + 1) > 3 THEN 0.8 * 0.8 ELSE 0.8 END AS t FROM n)
    SELECT doc_id, y FROM l UNION ALL SELECT doc_id, y FROM c, t WHERE confidence >= t""",
)
def m19_safe_group_mean(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    _, _, final = pseudo.iterate_safely(
        labelled, rest, _group_learner("lang", "source"), "y", "doc_id", threshold=0.8, max_iterations=1
    )
    return final.select("doc_id", "y")


@query(
    "m24_evaluate_group_means",
    f"""WITH {_DOCS}, k AS (SELECT lang, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM l, g GROUP BY 1),
    f AS (SELECT y, round(m.v, 9) AS a, round(k.v, 9) AS b FROM l JOIN m USING (lang, source) JOIN k USING (lang))
    SELECT 'teacher_both' AS model, round(auc, 6) AS score FROM {auc_sql('f', 'a')}
    UNION ALL SELECT 'teacher_lang', round(auc, 6) FROM {auc_sql('f', 'b')}""",
)
def m24_evaluate_group_means(spark, d):
    labelled, _ = _labelled_groups(spark, d)
    teachers = {"both": _group_learner("lang", "source"), "lang": _group_learner("lang")}
    run = distill.Distiller(teachers, _group_learner("lang"))
    run.fit_teachers(labelled)
    return rounded(run.evaluate(labelled, "y"))


@query(
    "m25_distillation_group_means",
    f"""WITH {_DOCS}, k AS (SELECT lang, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM l, g GROUP BY 1),
    z AS (SELECT doc_id, p AS a, coalesce(k.v, g) AS b FROM u JOIN p USING (doc_id) CROSS JOIN g LEFT JOIN k USING (lang)
      QUALIFY row_number() OVER (ORDER BY md5(concat_ws('_', '42', CAST(doc_id AS VARCHAR)))) <= floor(count(*) OVER () * 0.5)),
    w AS (SELECT doc_id, pow(a + 1e-8, 1 / 3.0) / (pow(a + 1e-8, 1 / 3.0) + pow(1 - a + 1e-8, 1 / 3.0)) AS a,
                 pow(b + 1e-8, 1 / 3.0) / (pow(b + 1e-8, 1 / 3.0) + pow(1 - b + 1e-8, 1 / 3.0)) AS b FROM z)
    SELECT doc_id, y::DOUBLE AS p, 'train' AS origin FROM l UNION ALL SELECT doc_id, round((a + b) / 2, 6), 'pseudo' FROM w""",
)
def m25_distillation_group_means(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    teachers = [_group_learner("lang", "source").fit(labelled), _group_learner("lang").fit(labelled)]
    out = distill.distillation_dataset(labelled, rest, teachers, "y", "doc_id", 2, ["doc_id"], 3.0, 0.5)
    return rounded(out.select("doc_id", F.element_at("soft_label", 2).alias("p"), "origin"))


@query(
    "m5_stack_row_mean",
    f"""WITH {FOLDED}, g AS (SELECT k AS fold, avg(y) AS g FROM folded, range(5) r(k) WHERE fold <> k GROUP BY k),
    a AS (SELECT o_custkey, g.fold, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM folded f JOIN g ON f.fold <> g.fold GROUP BY 1, 2),
    b AS (SELECT o_orderpriority, g.fold, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM folded f JOIN g ON f.fold <> g.fold GROUP BY 1, 2),
    n AS (SELECT c_custkey, p.o_orderpriority FROM customer, (SELECT DISTINCT o_orderpriority FROM orders) p),
    e AS (SELECT c_custkey, n.o_orderpriority, coalesce(a.v, g) AS x, coalesce(b.v, g) AS z FROM n CROSS JOIN g
          LEFT JOIN a ON a.o_custkey = c_custkey AND a.fold = g.fold LEFT JOIN b ON b.o_orderpriority = n.o_orderpriority AND b.fold = g.fold)
    SELECT c_custkey, o_orderpriority, round((avg(x) + avg(z)) / 2, 6) AS prediction FROM e GROUP BY 1, 2""",
)
def m5_stack_row_mean(spark, d):
    """New rows through every fold model of every base learner and the meta learner."""
    base = {"customer": _group_learner("o_custkey"), "priority": _group_learner("o_orderpriority")}
    stack = oof.Stack(base, lambda cols: RowMeanLearner(tuple(cols)), "y")
    stack.fit(_order_folds(spark, d), _KEY)
    kinds = table(spark, d, "orders").select("o_orderpriority").distinct()
    new = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("o_custkey")).crossJoin(F.broadcast(kinds))
    return rounded(stack.predict(new).select("c_custkey", "o_orderpriority", "prediction"))


@query(
    "m14_pseudo_group_mean",
    f"""WITH {_DOCS}, lf AS (SELECT *, ntile(3) OVER (PARTITION BY y ORDER BY md5(concat_ws('_', '42', CAST(doc_id AS VARCHAR)))) - 1 AS fold FROM l),
    gk AS (SELECT k, avg(y) AS g FROM lf, range(3) r(k) WHERE fold <> k GROUP BY k),
    mk AS (SELECT lang, source, k, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM lf JOIN gk ON fold <> k GROUP BY 1, 2, 3),
    pp AS (SELECT doc_id, avg(coalesce(v, g)) AS p FROM u CROSS JOIN gk LEFT JOIN mk USING (lang, source, k) GROUP BY 1),
    cc AS (SELECT doc_id, greatest(1 - p, p) AS confidence, CAST(p > 1 - p AS INTEGER) AS y FROM pp),
    ss AS (SELECT doc_id, y FROM cc WHERE confidence >= 0.72 QUALIFY
      row_number() OVER (ORDER BY md5(concat_ws('_', '42', CAST(doc_id AS VARCHAR)))) <= floor(count(*) OVER () * 0.5))
    SELECT doc_id, y, 'train' AS origin FROM l UNION ALL SELECT doc_id, y, 'pseudo' FROM ss""",
)
def m14_pseudo_group_mean(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    run = oof.OutOfFold(_group_learner("lang", "source"), "y", n_folds=3)
    run.fit_predict(splits.stratified_kfold(labelled, "doc_id", "y", 3), "doc_id")
    return pseudo.pseudo_label(labelled, rest, run.models, "y", "doc_id", threshold=0.72).select("doc_id", "y", "origin")


@query(
    "m21_self_paced_group_mean",
    f"""WITH {_DOCS}, e AS (SELECT count(*) AS n FROM l JOIN m USING (lang, source) WHERE 1 - greatest(1 - v, v) <= 0.3)
    SELECT 0 AS stage, 0.25::DOUBLE AS threshold, count(*) AS n_rows FROM l UNION ALL SELECT 1, 0.3::DOUBLE, n FROM e""",
)
def m21_self_paced_group_mean(spark, d):
    labelled, _ = _labelled_groups(spark, d)
    _, stages = curriculum.train_self_paced(labelled, _group_learner("lang", "source"), "y", threshold=0.25, n_stages=2)
    rows = [(i, round(t, 9), n) for i, (t, n) in enumerate(stages)]
    return spark.createDataFrame(rows, "stage int, threshold double, n_rows long")


@query(
    "m28_adversarial_group_mean",
    f"""WITH b AS (SELECT o_orderpriority, CAST(o_orderdate >= TIMESTAMP '1997-01-01' AS INTEGER) AS y, o_orderkey FROM orders),
    f AS (SELECT *, ntile(3) OVER (ORDER BY md5(concat_ws('_', '42', CAST(y AS VARCHAR), CAST(o_orderkey AS VARCHAR)))) - 1 AS fold FROM b),
    g AS (SELECT k, avg(y) AS g FROM f, range(3) r(k) WHERE fold <> k GROUP BY k),
    m AS (SELECT o_orderpriority, k, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM f JOIN g ON fold <> k GROUP BY 1, 2),
    o AS (SELECT y, coalesce(v, g) AS p FROM f JOIN g ON fold = g.k LEFT JOIN m ON m.k = g.k AND m.o_orderpriority = f.o_orderpriority)
    SELECT round(auc, 6) AS auc, n_pos, n_neg, auc > 0.5 AS shifted FROM {auc_sql('o', 'p')}""",
)
def m28_adversarial_group_mean(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_orderpriority", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    found, _ = oof.adversarial_validation(
        rows.filter(early), rows.filter(~early), ["o_orderpriority"], _KEY, lambda label: GroupMeanLearner(("o_orderpriority",), label)
    )
    return rounded(found)


_ROLE_MEANS = """g AS (SELECT split, avg(y) AS g FROM r WHERE role = 'train' GROUP BY 1),
  m AS (SELECT o_custkey, split, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM r JOIN g USING (split) WHERE role = 'train' GROUP BY 1, 2)
  SELECT o_orderkey, y, split, round(coalesce(v, g), 6) AS oof FROM r JOIN g USING (split) LEFT JOIN m USING (o_custkey, split) WHERE role = 'test'"""


def _over_roles(spark, d, strategy, **options):
    rows = orders(spark, d).select(_KEY, "o_custkey", "o_orderdate", "y")
    parts = splits.assign_folds(rows, _KEY, strategy, 5, time="o_orderdate", **options)
    run = oof.OutOfFold(GroupMeanLearner(("o_custkey",), "y"), "y", fold="split", role="role")
    return rounded(run.fit_predict(parts, _KEY))


@query(
    "m1_oof_time",
    f"""WITH {ORDERS}, p AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS index, count(*) OVER () AS n FROM base),
    e AS (SELECT *, n - (5 - split) * (n // 6) AS start, n // 6 AS size FROM p, (SELECT CAST(unnest(range(5)) AS INTEGER) AS split)),
    r AS (SELECT *, CASE WHEN index < start THEN 'train' ELSE 'test' END AS role FROM e WHERE index < start + size), {_ROLE_MEANS}""",
)
def m1_oof_time(spark, d):
    return _over_roles(spark, d, "time")


@query(
    "m1_oof_purged",
    f"""WITH {ORDERS}, p AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS index, count(*) OVER () AS n FROM base),
    b AS (SELECT *, split * (n // 5) AS a, CASE WHEN split = 4 THEN n ELSE (split + 1) * (n // 5) END AS z
          FROM p, (SELECT CAST(unnest(range(5)) AS INTEGER) AS split)),
    e AS (SELECT *, CAST(floor((z - a) * 0.01) AS BIGINT) AS emb FROM b),
    r AS (SELECT *, CASE WHEN index >= a AND index < z THEN 'test' ELSE 'train' END AS role FROM e
          WHERE (index >= a AND index < z) OR index < a - 20 OR index >= z + 20 + emb), {_ROLE_MEANS}""",
)
def m1_oof_purged(spark, d):
    return _over_roles(spark, d, "purged", purge_gap=20, embargo_pct=0.01)


@query(
    "k6_multiclass",
    f"""WITH {_PROBS}, e AS (SELECT vec_id, vec_id % 5 AS fold, avg((p - CAST(label = i AS INTEGER)) * (p - CAST(label = i AS INTEGER))) AS b FROM p GROUP BY 1, 2)
    SELECT fold, round(-avg(b), 6) AS score FROM e GROUP BY 1""",
)
def k6_multiclass(spark, d):
    """The default score of class-probability arrays."""
    rows = class_probs(spark, d).withColumn("fold", F.col("vec_id") % 5)
    return rounded(metrics.fold_scores(rows, "label", "p")[0])


@query(
    "c3_null_groups",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS g FROM events),
       s AS (SELECT g, count(*) AS n FROM e WHERE g IS NOT NULL GROUP BY 1),
       r AS (SELECT g, (row_number() OVER (ORDER BY n DESC, g) - 1) % 10 AS t FROM s)
       SELECT event_id, CAST(CASE WHEN e.g IS NULL THEN CAST('0x' || substr(md5('42_' || CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 5
              WHEN t < 5 THEN t ELSE 9 - t END AS INTEGER) AS fold
       FROM e LEFT JOIN r ON r.g = e.g""",
)
def c3_null_groups(spark, d):
    g = F.when(F.col("event_id") % 10 != 0, F.col("user_id"))
    rows = table(spark, d, "events").select("event_id", g.alias("g"))
    return splits.group_kfold(rows, "g", 5, "event_id").select("event_id", "fold")


@query(
    "a14_majority_of_strings",
    """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)
       SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_classes, first(o_orderpriority ORDER BY n DESC, o_orderpriority) AS majority
       FROM c GROUP BY 1""",
)
def a14_majority_of_strings(spark, d):
    from foldwright.operators.groupby import majority_class

    return majority_class(table(spark, d, "orders"), "o_custkey", "o_orderpriority")


@query(
    "c7_string_labels",
    """WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
       m AS (SELECT o_custkey, first(o_orderpriority ORDER BY n DESC, o_orderpriority) AS majority FROM c GROUP BY 1),
       r AS (SELECT o_custkey, CAST((row_number() OVER (ORDER BY majority, o_custkey) - 1) % 5 AS INTEGER) AS fold FROM m)
       SELECT o_orderkey, fold FROM orders JOIN r USING (o_custkey)""",
)
def c7_string_labels(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_custkey", "o_orderpriority")
    return splits.stratified_group_kfold(rows, "o_custkey", "o_orderpriority").select(_KEY, "fold")


_FOLD_FITS = f"""{FOLDED}, g AS (SELECT k AS fold, avg(y) AS g, count(*)::DOUBLE AS n FROM folded, range(5) r(k) WHERE fold <> k GROUP BY k),
  a AS (SELECT o_custkey, g.fold, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM folded f JOIN g ON f.fold <> g.fold GROUP BY 1, 2),
  b AS (SELECT o_custkey, g.fold, count(*) / any_value(n) AS s FROM folded f JOIN g ON f.fold <> g.fold GROUP BY 1, 2)"""


def _fold_features():
    return oof.FoldFeatures({"target": _group_learner("o_custkey"), "share": GroupShareLearner(("o_custkey",))})


@query(
    "e10_transformer_list",
    f"""WITH {_FOLD_FITS} SELECT o_orderkey, fold, round(coalesce(v, g), 6) AS oof_target, round(coalesce(s, 0), 9) AS oof_share
    FROM folded JOIN g USING (fold) LEFT JOIN a USING (o_custkey, fold) LEFT JOIN b USING (o_custkey, fold)""",
)
def e10_transformer_list(spark, d):
    out = _fold_features().fit_transform(_order_folds(spark, d))
    return out.select(_KEY, "fold", F.round("oof_target", 6).alias("oof_target"), F.round("oof_share", 9).alias("oof_share"))


@query(
    "e10_transformer_list_new_rows",
    f"""WITH {_FOLD_FITS} SELECT c_custkey, round(avg(coalesce(v, g)), 6) AS oof_target, round(avg(coalesce(s, 0)) * 1000, 6) AS share_1000
    FROM customer CROSS JOIN g LEFT JOIN a ON a.o_custkey = c_custkey AND a.fold = g.fold
    LEFT JOIN b ON b.o_custkey = c_custkey AND b.fold = g.fold GROUP BY 1""",
)
def e10_transformer_list_new_rows(spark, d):
    run = _fold_features()
    run.fit_transform(_order_folds(spark, d))
    out = run.transform(table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("o_custkey")))
    return rounded(out.select("c_custkey", "oof_target", (F.col("oof_share") * 1000).alias("share_1000")))


@query(
    "f5_binary_temperature",
    f"""WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1 - 1 / (1 + exp(-ln(m_quantity + 1e-8) / 2)), 6) AS p0,
        round(1 / (1 + exp(-ln(m_quantity + 1e-8) / 2)), 6) AS p1 FROM t""",
)
def f5_binary_temperature(spark, d):
    p = vectors.binary_temperature_scale(F.col("m_quantity"), 2.0)
    return rounded(scored(spark, d).select(*_IDS, F.get(p, 0).alias("p0"), F.get(p, 1).alias("p1")))
