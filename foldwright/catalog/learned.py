"""Learners with a closed form, whose flows SQL can repeat: folds, importances, elimination, curricula, rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.checks import _LABELLED, _labelled
from foldwright.catalog.models import _CENTRE, _group_learner, _labelled_groups
from foldwright.catalog.registry import FOLDED, ORDERS, orders, query, rounded
from foldwright.operators import curriculum, oof, pseudo, select, splits
from foldwright.operators.closed_form import LeastSquaresLearner, StumpLearner

_KEY = "o_orderkey"
_OF_ORDER = {"year": "year(o_orderdate)", "price": "o_totalprice", "month": "month(o_orderdate)"}
_OF_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ----------------------------------------------------------------- stumps

#: best cut of every feature ``f`` and fold ``k`` of ``long(k, f, x, y)``
_STUMPS = """r AS (SELECT k, f, min(x) AS lo, max(x) AS hi FROM long GROUP BY ALL),
  b AS (SELECT k, f, CAST(least(floor((x - lo) / (hi - lo) * 16), 15) AS INTEGER) AS bin, count(*) AS n, CAST(sum(y) AS DOUBLE) AS s
        FROM long JOIN r USING (k, f) WHERE lo < hi GROUP BY ALL),
  c AS (SELECT k, f, bin, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY k, f) AS nn, sum(s) OVER (PARTITION BY k, f) AS ss
        FROM b WINDOW w AS (PARTITION BY k, f ORDER BY bin)),
  q AS (SELECT *, sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) - ss * ss / nn AS gain FROM c WHERE nl < nn),
  best AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY k, f ORDER BY gain DESC, bin) = 1),
  shares AS (SELECT k, f, gain / sum(gain) OVER (PARTITION BY k) AS share FROM best)"""

_FOLD_STUMPS = (
    f"{FOLDED}, long AS ("
    + " UNION ALL ".join(
        f"SELECT k, {i} AS f, CAST({x} AS DOUBLE) AS x, y FROM folded, range(5) t(k) WHERE fold <> k"
        for i, x in enumerate(_OF_ORDER.values())
    )
    + f"), {_STUMPS}"
)
_NAMES = "['year', 'price', 'month'][f + 1]"


def _dated(spark, d):
    return orders(spark, d).select(
        _KEY, "y", "o_orderpriority", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"), F.month("o_orderdate").alias("month")
    )


def _fold_run(spark, d, learner):
    run = oof.OutOfFold(learner, "y", early_stopping=False)
    run.fit_predict(splits.stratified_kfold(_dated(spark, d), _KEY, "y"), _KEY)
    return run


@query(
    "m1_oof_stump",
    f"""WITH {_FOLD_STUMPS}, top AS (SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY k ORDER BY gain DESC, f) = 1)
    SELECT o_orderkey, y, fold, round(CASE WHEN floor(([year(o_orderdate), o_totalprice, month(o_orderdate)][f + 1] - lo) / (hi - lo) * 16) <= bin
      THEN sl / nl ELSE (ss - sl) / (nn - nl) END, 6) AS oof FROM folded JOIN top ON k = fold JOIN r USING (k, f)""",
)
def m1_oof_stump(spark, d):
    return rounded(_fold_run(spark, d, StumpLearner(tuple(_OF_ORDER), "y")).predictions)


@query("m3_fold_importance_stump", f"WITH {_FOLD_STUMPS} SELECT {_NAMES} AS feature, round(avg(share), 6) AS importance FROM shares GROUP BY f")
def m3_fold_importance_stump(spark, d):
    run = _fold_run(spark, d, StumpLearner(tuple(_OF_ORDER), "y"))
    return rounded(spark.createDataFrame(run.importances(list(_OF_ORDER)), "feature string, importance double"))


_LINE_STUMPS = (
    f"{_LABELLED}, long AS ("
    + " UNION ALL ".join(f"SELECT 0 AS k, {i} AS f, CAST({c} AS DOUBLE) AS x, y FROM t" for i, c in enumerate(_OF_LINE))
    + f"), {_STUMPS}"
)


@query("n3_stump_importance", f"WITH {_LINE_STUMPS} SELECT {_OF_LINE}[f + 1] AS feature, round(share, 6) AS score FROM shares")
def n3_stump_importance(spark, d):
    return rounded(select.learner_importance(_labelled(spark, d), _OF_LINE, lambda f: StumpLearner(f, "y")))


# ---------------------------------------------------------- least squares


@query(
    "m1_oof_least_squares",
    f"""WITH {FOLDED}, long AS (SELECT k, CAST(year(o_orderdate) AS DOUBLE) AS u, o_totalprice AS v, y FROM folded, range(5) t(k) WHERE fold <> k),
    s AS (SELECT k, avg(u) AS mu, avg(v) AS mv, avg(y) AS my, var_pop(u) AS uu, var_pop(v) AS vv, covar_pop(u, v) AS uv,
      covar_pop(u, y) AS uy, covar_pop(v, y) AS vy FROM long GROUP BY 1),
    w AS (SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS wu, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS wv FROM s)
    SELECT o_orderkey, y, fold, round(least(greatest(my + (year(o_orderdate) - mu) * wu + (o_totalprice - mv) * wv, 0), 1), 6) AS oof
    FROM folded JOIN w ON k = fold""",
)
def m1_oof_least_squares(spark, d):
    return rounded(_fold_run(spark, d, LeastSquaresLearner(("year", "price"), "y")).predictions)


#: absolute standardised coefficients on three features, and on every two of them
_BETAS = f"""{_LABELLED}, r AS (SELECT corr(l_quantity, l_extendedprice) AS r12, corr(l_quantity, l_discount) AS r13, corr(l_extendedprice, l_discount) AS r23,
    corr(l_quantity, y) AS r1, corr(l_extendedprice, y) AS r2, corr(l_discount, y) AS r3 FROM t),
  e AS (SELECT *, 1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det FROM r),
  three AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature, unnest([
    abs(r1 * (1 - r23 * r23) + r2 * (r13 * r23 - r12) + r3 * (r12 * r23 - r13)) / det,
    abs(r1 * (r13 * r23 - r12) + r2 * (1 - r13 * r13) + r3 * (r12 * r13 - r23)) / det,
    abs(r1 * (r12 * r23 - r13) + r2 * (r12 * r13 - r23) + r3 * (1 - r12 * r12)) / det]) AS score FROM e)"""
_THREE = ["l_quantity", "l_extendedprice", "l_discount"]


@query("n3_least_squares_importance", f"WITH {_BETAS} SELECT feature, round(score, 6) AS score FROM three")
def n3_least_squares_importance(spark, d):
    return rounded(select.learner_importance(_labelled(spark, d), _THREE, lambda f: LeastSquaresLearner(f, "y")))


@query(
    "n4_elimination_least_squares",
    f"""WITH {_BETAS}, two AS (SELECT feature FROM three QUALIFY row_number() OVER (ORDER BY score, feature) > 1),
    p AS (SELECT a.feature AS a, b.feature AS b FROM two a JOIN two b ON a.feature <> b.feature),
    y AS (SELECT a, CASE a WHEN 'l_quantity' THEN r1 WHEN 'l_extendedprice' THEN r2 ELSE r3 END AS ra,
      CASE b WHEN 'l_quantity' THEN r1 WHEN 'l_extendedprice' THEN r2 ELSE r3 END AS rb,
      CASE WHEN 'l_discount' NOT IN (a, b) THEN r12 WHEN 'l_extendedprice' NOT IN (a, b) THEN r13 ELSE r23 END AS rab FROM p, r),
    one AS (SELECT a AS feature FROM y ORDER BY abs(ra - rb * rab) DESC, a DESC LIMIT 1)
    SELECT 2 AS n_keep, feature FROM two UNION ALL SELECT 1, feature FROM one""",
)
def n4_elimination_least_squares(spark, d):
    rows = _labelled(spark, d).select("y", *_THREE)
    kept = [(n, f) for n in (2, 1) for f in select.eliminate_by(rows, _THREE, lambda f: LeastSquaresLearner(f, "y"), n)]
    return spark.createDataFrame(kept, "n_keep int, feature string")


# -------------------------------------------------------------- curricula

_EXACT_CENTRE = _CENTRE.replace("round(sqrt((u - cu) * (u - cu) + (v - cv) * (v - cv)), 6)", "sqrt((u - cu) * (u - cu) + (v - cv) * (v - cv))")


def _means_sql(name: str, source: str) -> str:
    """SQL for the smoothed means by priority that a group-mean learner fits on ``source``."""
    return f"{name} AS (SELECT o_orderpriority, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM {source}, (SELECT avg(y) AS g FROM {source}) GROUP BY 1)"


_FIRST = f"""{ORDERS}, {_EXACT_CENTRE}, n AS (SELECT CAST(floor(count(*) * CAST(0.4 AS DOUBLE)) AS BIGINT) AS first, count(*) AS n FROM base),
  e AS (SELECT base.* FROM base JOIN w USING (o_orderkey) ORDER BY difficulty, o_orderkey LIMIT (SELECT first FROM n)),
  {_means_sql('m0', 'e')},
  h AS (SELECT base.*, 1 - greatest(1 - v, v) AS difficulty FROM base JOIN m0 USING (o_orderpriority))"""


@query(
    "m20_curriculum_group_mean",
    f"""WITH {_FIRST}, s AS (SELECT least(CAST(floor(first / CAST(0.4 AS DOUBLE)) AS BIGINT), n) AS second FROM n),
    e1 AS (SELECT * FROM h ORDER BY difficulty, o_orderkey LIMIT (SELECT second FROM s)), {_means_sql('m1', 'e1')}
    SELECT o_orderpriority, round(m0.v, 6) AS stage0, round(m1.v, 6) AS stage1, first AS size0, second AS size1
    FROM m0 JOIN m1 USING (o_orderpriority), n, s""",
)
def m20_curriculum_group_mean(spark, d):
    rows = _dated(spark, d)
    models, sizes = curriculum.train_curriculum(
        rows.select(_KEY, "y", "o_orderpriority", "price", "month"), _group_learner("o_orderpriority"), "y", _KEY, ["price", "month"], n_stages=2, ratio=0.4
    )
    out = rows.select("o_orderpriority").distinct()
    for i, (model, size) in enumerate(zip(models, sizes)):
        out = model.score(out, f"stage{i}").withColumn(f"size{i}", F.lit(size).cast("long"))
    return rounded(out)


@query(
    "m20_remeasured_prefix",
    f"WITH {_FIRST} SELECT o_orderkey, round(difficulty, 6) AS difficulty FROM h ORDER BY h.difficulty, o_orderkey LIMIT (SELECT n // 4 FROM n)",
)
def m20_remeasured_prefix(spark, d):
    rows = _dated(spark, d)
    ranked = curriculum.centroid_distance(rows, "y", ["price", "month"])
    n = rows.count()
    model = _group_learner("o_orderpriority").fit(curriculum.easiest(ranked, _KEY, int(n * 0.4)))
    hard = curriculum.model_difficulty(rows, model, "y", (0, 1))
    return rounded(curriculum.easiest(hard, _KEY, n // 4).select(_KEY, curriculum.DIFFICULTY))


# ------------------------------------------------- two rounds of pseudo-labels


def _round_sql(i: int, train: str, rest: str) -> str:
    """SQL for one round: ``c{i}`` holds the guess and confidence of every row of ``rest``."""
    return f"""g{i} AS (SELECT avg(y) AS g FROM {train}),
  m{i} AS (SELECT lang, source, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM {train}, g{i} GROUP BY 1, 2),
  c{i} AS (SELECT doc_id, lang, source, greatest(1 - p, p) AS confidence, CAST(p > 1 - p AS INTEGER) AS y
    FROM (SELECT doc_id, lang, source, coalesce(v, g) AS p FROM {rest} CROSS JOIN g{i} LEFT JOIN m{i} USING (lang, source)))"""


_START = """l AS (SELECT doc_id, lang, source, quality AS y FROM documents JOIN labels USING (doc_id)),
  u AS (SELECT doc_id, lang, source FROM documents ANTI JOIN labels USING (doc_id))"""


def _sampled(i: int, threshold: float) -> str:
    return f"""s{i} AS (SELECT doc_id, lang, source, y FROM c{i} WHERE confidence >= {threshold} QUALIFY
      row_number() OVER (ORDER BY md5(concat_ws('_', '{42 + i}', CAST(doc_id AS VARCHAR)))) <= floor(count(*) OVER () * 0.5))"""


@query(
    "m15_iterate_two_rounds",
    f"""WITH {_START}, {_round_sql(0, 'l', 'u')}, {_sampled(0, 0.72)},
    l1 AS (SELECT * FROM l UNION ALL SELECT * FROM s0), u1 AS (SELECT * FROM u ANTI JOIN s0 USING (doc_id)),
    {_round_sql(1, 'l1', 'u1')}, {_sampled(1, 0.72)}
    SELECT doc_id, y FROM l1 UNION ALL SELECT doc_id, y FROM s1""",
)
def m15_iterate_two_rounds(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    learner = _group_learner("lang", "source")
    _, _, final = pseudo.iterate(labelled, rest, learner, "y", "doc_id", threshold=0.72, max_iterations=2)
    return final.select("doc_id", "y")


def _most(i: int) -> str:
    return f"""s{i} AS (SELECT doc_id, lang, source, y FROM c{i} WHERE confidence >= 0.6 ORDER BY round(confidence, 9) DESC, doc_id
      LIMIT (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM u))"""


@query(
    "m18_top_two_rounds",
    f"""WITH {_START}, {_round_sql(0, 'l', 'u')}, {_most(0)}, l1 AS (SELECT * FROM l UNION ALL SELECT * FROM s0),
    {_round_sql(1, 'l1', 'u')}, {_most(1)}
    SELECT doc_id, y FROM l UNION ALL SELECT doc_id, y FROM s1""",
)
def m18_top_two_rounds(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    learner = _group_learner("lang", "source")
    _, _, final = pseudo.iterate_top(labelled, rest, learner, "y", "doc_id", threshold=0.6, sample_ratio=0.2, max_iterations=2)
    return final.select("doc_id", "y")


def _balanced(i: int) -> str:
    return f"""n{i} AS (SELECT y, count(*) AS n FROM c{i} WHERE confidence >= 0.72 GROUP BY 1),
    t{i} AS (SELECT CASE WHEN count(*) = 2 AND max(n) / (min(n) + 1) > 3 THEN CAST(0.72 AS DOUBLE) * CAST(0.8 AS DOUBLE) ELSE CAST(0.72 AS DOUBLE) END AS t FROM n{i}),
    s{i} AS (SELECT doc_id, lang, source, y FROM c{i}, t{i} WHERE confidence >= t)"""


@query(
    "m19_safe_two_rounds",
    f"""WITH {_START}, {_round_sql(0, 'l', 'u')}, {_balanced(0)},
    l1 AS (SELECT * FROM l UNION ALL SELECT * FROM s0), u1 AS (SELECT * FROM u ANTI JOIN s0 USING (doc_id)),
    {_round_sql(1, 'l1', 'u1')}, {_balanced(1)}
    SELECT doc_id, y FROM l1 UNION ALL SELECT doc_id, y FROM s1""",
)
def m19_safe_two_rounds(spark, d):
    labelled, rest = _labelled_groups(spark, d)
    learner = _group_learner("lang", "source")
    _, _, final = pseudo.iterate_safely(labelled, rest, learner, "y", "doc_id", threshold=0.72, max_iterations=2)
    return final.select("doc_id", "y")
