"""Metrics, blends and diversity on scores derived from line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import query, rounded
from foldwright.functions import scalars
from foldwright.operators import blend, metrics, splits
from foldwright.sources.tables import table

MODELS = ["m_quantity", "m_discount", "m_tax", "m_line"]
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def scored(spark, d):
    """Four scores in [0, 1) for the label 'discounted quantity above 25'."""
    return table(spark, d, "lineitem").select(
        *_KEYS,
        (F.col("l_quantity") * (1 - F.col("l_discount")) > 25).cast("int").alias("y"),
        (F.col("l_quantity") / 51.0).alias("m_quantity"),
        (F.col("l_discount") / 0.11).alias("m_discount"),
        (F.col("l_tax") / 0.09).alias("m_tax"),
        (F.col("l_linenumber") / 8.0).alias("m_line"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )


SCORED = """t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity * (1 - l_discount) > 25 AS INTEGER) AS y,
  l_quantity / 51.0::DOUBLE AS m_quantity, l_discount / 0.11::DOUBLE AS m_discount, l_tax / 0.09::DOUBLE AS m_tax,
  l_linenumber / 8.0::DOUBLE AS m_line, l_extendedprice AS price, l_returnflag AS flag FROM lineitem)"""


def auc_sql(source: str, score: str, by: str = "") -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc,
      sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg FROM
      (SELECT *, coalesce(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
       FROM (SELECT {keys}{score} AS s, sum(y)::DOUBLE AS pos, sum(1 - y)::DOUBLE AS neg FROM {source} GROUP BY ALL) g) w {group})"""


_SE = """sqrt((auc * (1 - auc) + (n_pos - 1) * (auc / (2 - auc) - auc * auc)
  + (n_neg - 1) * (2 * auc * auc / (1 + auc) - auc * auc)) / (n_pos::DOUBLE * n_neg))"""


@query("k1_auc", f"WITH {SCORED} SELECT round(auc, 8) AS auc, n_pos, n_neg FROM {auc_sql('t', 'm_quantity')}")
def k1_auc(spark, d):
    return rounded(metrics.auc(scored(spark, d), "y", "m_quantity"), 8)


@query(
    "k1_auc_by_group",
    f"WITH {SCORED} SELECT flag, round(auc, 8) AS auc, n_pos, n_neg FROM {auc_sql('t', 'm_quantity * 0.6 + m_tax * 0.4', 'flag')}",
)
def k1_auc_by_group(spark, d):
    rows = scored(spark, d).withColumn("s", F.col("m_quantity") * 0.6 + F.col("m_tax") * 0.4)
    return rounded(metrics.auc(rows, "y", "s", ["flag"]), 8)


@query(
    "k2_binary_report",
    f"""WITH {SCORED}, c AS (SELECT flag, y, CAST(m_quantity > 0.5 AS INTEGER) AS g FROM t)
    SELECT flag, round(avg(CAST(y = g AS DOUBLE)), 6) AS accuracy, round(sum(y * g) / sum(g), 6) AS precision,
    round(sum(y * g) / sum(y), 6) AS recall, round(2 * sum(y * g) / (sum(y) + sum(g)), 6) AS f1 FROM c GROUP BY 1""",
)
def k2_binary_report(spark, d):
    return rounded(metrics.binary_report(scored(spark, d), "y", "m_quantity", ["flag"]))


_CLASS = """c AS (SELECT l_returnflag AS t, CASE WHEN l_linestatus = 'F' THEN 'A' WHEN l_quantity > 25 THEN 'N' ELSE 'R' END AS g
  FROM lineitem), k AS (SELECT DISTINCT t AS class FROM c UNION SELECT DISTINCT g FROM c),
  p AS (SELECT class, (SELECT count(*) FROM c WHERE t = class) AS support, (SELECT count(*) FROM c WHERE g = class) AS said,
        (SELECT count(*) FROM c WHERE t = class AND g = class) AS hit FROM k)"""


def _classes(spark, d):
    guess = F.when(F.col("l_linestatus") == "F", "A").when(F.col("l_quantity") > 25, "N").otherwise("R")
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("t"), guess.alias("g"))


@query(
    "k2_class_report",
    f"""WITH {_CLASS} SELECT class, support, round(hit / said, 6) AS precision, round(hit / support, 6) AS recall,
        round(2 * hit / (said + support), 6) AS f1, said, hit FROM p""",
)
def k2_class_report(spark, d):
    return rounded(metrics.class_report(_classes(spark, d), "t", "g"))


@query(
    "k2_averaged_report",
    f"""WITH {_CLASS}, q AS (SELECT *, hit / said AS precision, hit / support AS recall, 2 * hit / (said + support) AS f1 FROM p)
    SELECT round(sum(hit) / sum(support), 6) AS accuracy, """
    + ", ".join(
        f"round(sum(hit) / sum(support), 6) AS {m}_micro, round(avg({m}), 6) AS {m}_macro, "
        f"round(sum({m} * support) / sum(support), 6) AS {m}_weighted"
        for m in ("precision", "recall", "f1")
    )
    + " FROM q",
)
def k2_averaged_report(spark, d):
    return rounded(metrics.averaged_report(_classes(spark, d), "t", "g"))


@query(
    "k3_regression_report",
    f"""WITH {SCORED}, p AS (SELECT flag, price AS y, m_quantity * 100000 AS g FROM t)
    SELECT flag, round(sqrt(avg((y - g) * (y - g))), 4) AS rmse, round(avg(abs(y - g)), 4) AS mae,
    round(1 - sum((y - g) * (y - g)) / (var_pop(y) * count(y)), 6) AS r2 FROM p GROUP BY 1""",
)
def k3_regression_report(spark, d):
    rows = scored(spark, d).withColumn("g", F.col("m_quantity") * 100000)
    out = metrics.regression_report(rows, "price", "g", ["flag"])
    return out.select("flag", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


_CLIP = "least(greatest(m_quantity, 1e-7::DOUBLE), (1 - 1e-7)::DOUBLE)"


@query(
    "k4_log_loss",
    f"WITH {SCORED} SELECT flag, round(-avg(CASE WHEN y = 1 THEN ln({_CLIP}) ELSE ln(1 - {_CLIP}) END), 8) AS score FROM t GROUP BY 1",
)
def k4_log_loss(spark, d):
    return rounded(metrics.score(scored(spark, d), "y", "m_quantity", "logloss", ["flag"]), 8)


@query(
    "f13_clip",
    f"""WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(least(greatest(m_discount * 1.2 - 0.1, 1e-7::DOUBLE), (1 - 1e-7)::DOUBLE), 8) AS p FROM t""",
)
def f13_clip(spark, d):
    p = scalars.clip_probability(F.col("m_discount") * 1.2 - 0.1)
    return rounded(scored(spark, d).select(*_KEYS, p.alias("p")), 8)


@query(
    "k5_auc_error",
    f"WITH {SCORED} SELECT flag, round(auc, 8) AS auc, n_pos, n_neg, round({_SE}, 8) AS auc_se FROM {auc_sql('t', 'm_quantity', 'flag')}",
)
def k5_auc_error(spark, d):
    return rounded(metrics.auc_error(metrics.auc(scored(spark, d), "y", "m_quantity", ["flag"])), 8)


_FOLDS = """f AS (SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY md5(concat_ws('_', '42', CAST(o_orderkey AS VARCHAR))),
  o_orderkey) - 1 AS INTEGER) AS fold FROM orders), tf AS (SELECT t.*, fold FROM t JOIN f ON l_orderkey = o_orderkey)"""


def _folded_scores(spark, d):
    folds = splits.kfold(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return scored(spark, d).join(folds.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")


@query(
    "k6_fold_scores",
    f"WITH {SCORED}, {_FOLDS} SELECT fold, round(auc, 8) AS score FROM {auc_sql('tf', 'm_quantity', 'fold')}",
)
def k6_fold_scores(spark, d):
    return rounded(metrics.fold_scores(_folded_scores(spark, d), "y", "m_quantity", n_classes=2)[0], 8)


@query(
    "k6_fold_summary",
    f"""WITH {SCORED}, {_FOLDS}, s AS (SELECT fold, -avg((price - m_quantity * 100000) * (price - m_quantity * 100000)) AS score
        FROM tf GROUP BY 1) SELECT round(avg(score), 0) AS mean, round(stddev_pop(score), 0) AS std FROM s""",
)
def k6_fold_summary(spark, d):
    rows = _folded_scores(spark, d).withColumn("g", F.col("m_quantity") * 100000)
    return rounded(metrics.fold_scores(rows, "price", "g", n_classes=99)[1], 0)


_K7 = """WITH t AS (SELECT l_extendedprice AS x, l_extendedprice * (1 - l_discount) AS y FROM lineitem),
  r AS (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
               rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM t)
  SELECT round(corr(x, y), 8) AS pearson_r, 0.0::DOUBLE AS pearson_p, round(corr(rx, ry), 8) AS spearman_r,
         0.0::DOUBLE AS spearman_p, count(*) AS n, corr(x, y) > 0.7 AS reliable FROM r"""


@query("k7_correlations", _K7)
def k7_correlations(spark, d):
    rows = table(spark, d, "lineitem").withColumn("paid", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return rounded(metrics.correlation_report(rows, "l_extendedprice", "paid"), 8)


# -------------------------------------------------------------------- blends

_BLEND = f"WITH {SCORED} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({{}}, 6) AS blend FROM t"
_WEIGHTS = {"m_quantity": 4.0, "m_discount": 2.0, "m_tax": 1.0, "m_line": 1.0}


def _blended(spark, d, **options):
    return rounded(blend.blend(scored(spark, d), MODELS, **options).select(*_KEYS, "blend"))


@query("m7_blend_weighted", _BLEND.format("m_quantity * 0.5 + m_discount * 0.25 + m_tax * 0.125 + m_line * 0.125"))
def m7_blend_weighted(spark, d):
    return _blended(spark, d, weights=_WEIGHTS)


@query("f16_row_mean", _BLEND.format("(m_quantity + m_discount + m_tax + m_line) / 4"))
def f16_row_mean(spark, d):
    return _blended(spark, d, method="mean")


@query("f16_row_median", _BLEND.format("list_median([m_quantity, m_discount, m_tax, m_line])"))
def f16_row_median(spark, d):
    return _blended(spark, d, method="median")


@query(
    "f16_row_geometric_mean",
    _BLEND.format(
        "CASE WHEN least(m_quantity, m_discount, m_tax, m_line) = 0 THEN 0 ELSE "
        "exp((ln(greatest(m_quantity, 1e-300)) + ln(greatest(m_discount, 1e-300)) + ln(greatest(m_tax, 1e-300))"
        " + ln(greatest(m_line, 1e-300))) / 4) END"
    ),
)
def f16_row_geometric_mean(spark, d):
    return _blended(spark, d, method="geometric")


_CANDIDATES = [[0.25, 0.25, 0.25, 0.25], [0.5, 0.5, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0], [0.75, 0.0, 0.25, 0.0]]


def _mix(w):
    return " + ".join(f"{m} * {v}::DOUBLE" for m, v in zip(MODELS, w))


@query(
    "m8_score_candidates_auc",
    f"WITH {SCORED} " + " UNION ALL ".join(
        f"SELECT {i} AS candidate, round(auc, 8) AS score FROM {auc_sql('t', _mix(w))}" for i, w in enumerate(_CANDIDATES)
    ),
)
def m8_score_candidates_auc(spark, d):
    found = blend.score_weights(scored(spark, d), "y", MODELS, _CANDIDATES, "auc")
    return rounded(spark.createDataFrame(list(enumerate(found)), "candidate int, score double"), 8)


@query(
    "m8_score_candidates_rmse",
    f"WITH {SCORED} " + " UNION ALL ".join(
        f"SELECT {i} AS candidate, round(sqrt(avg((y - ({_mix(w)})) * (y - ({_mix(w)})))), 8) AS score FROM t"
        for i, w in enumerate(_CANDIDATES)
    ),
)
def m8_score_candidates_rmse(spark, d):
    found = blend.score_weights(scored(spark, d), "y", MODELS, _CANDIDATES, "rmse")
    return rounded(spark.createDataFrame(list(enumerate(found)), "candidate int, score double"), 8)


@query("m8_hill_climb")
def m8_hill_climb(spark, d):
    weights, best = blend.hill_climb(scored(spark, d), "y", MODELS, "auc", max_iterations=48, step=0.05, patience=32)
    return spark.createDataFrame([(m, w, best) for m, w in weights.items()], "model string, weight double, score double")


@query("m9_weight_sweep")
def m9_weight_sweep(spark, d):
    weights, best = blend.sweep_weights(scored(spark, d), "y", MODELS, "logloss", step=0.05, smallest_step=0.01)
    return spark.createDataFrame([(m, w, best) for m, w in weights.items()], "model string, weight double, score double")


def _sweep_sql(a: str, b: str, step: float, smallest: float) -> str:
    """The sweep of two weights unrolled as a recursion: the score of any weights is a closed form of second moments."""
    error = "(x * x * aa + 2 * x * (1 - x) * ab + (1 - x) * (1 - x) * bb - 2 * x * ay - 2 * (1 - x) * zy + yy)"
    moves = [f"(w {d} step)" for d in "-+"]
    shares = [f"greatest({m}, 0) / (greatest({m}, 0) + 1 - w)" for m in moves]
    shares += [f"w / (w + greatest(1 - w {d} step, 0))" for d in "-+"]
    scored_moves = ", ".join("{'e': " + error.replace("x", f"({x})") + f", 'w': {x}}}" for x in shares)
    return f"""WITH RECURSIVE {SCORED}, m AS (SELECT avg({a} * {a}) AS aa, avg({a} * {b}) AS ab, avg({b} * {b}) AS bb,
      avg({a} * y) AS ay, avg({b} * y) AS zy, avg(y * y) AS yy FROM t),
    s AS (SELECT 0 AS k, 0.5::DOUBLE AS w, {step}::DOUBLE AS step, false AS done
      UNION ALL
      SELECT k + 1, CASE WHEN better THEN top.w ELSE w END, CASE WHEN better THEN step ELSE step / 2 END, NOT better AND step / 2 < {smallest}
      FROM (SELECT *, top.e < {error.replace("x", "w")} AS better FROM
        (SELECT s.*, m.*, list_min([{scored_moves}]) AS top FROM s, m WHERE NOT done AND k < 100) c) d),
    z AS (SELECT w, sqrt({error.replace("x", "w")}) AS score FROM s, m ORDER BY k DESC LIMIT 1)
    SELECT '{a}' AS model, round(w, 4) AS weight, round(score, 6) AS score FROM z
    UNION ALL SELECT '{b}', round(1 - w, 4), round(score, 6) FROM z"""


@query("m9_weight_sweep_rmse", _sweep_sql("m_quantity", "m_tax", 0.05, 0.01))
def m9_weight_sweep_rmse(spark, d):
    weights, best = blend.sweep_weights(scored(spark, d), "y", ["m_quantity", "m_tax"], "rmse", step=0.05, smallest_step=0.01)
    return spark.createDataFrame([(m, w, round(best, 6)) for m, w in weights.items()], "model string, weight double, score double")


@query(
    "m10_size_curve",
    f"WITH {SCORED} " + " UNION ALL ".join(
        f"SELECT {k} AS ensemble_size, round(auc, 8) AS cv_score, '{','.join(MODELS[:k])}' AS models FROM "
        + auc_sql("t", f"({' + '.join(MODELS[:k])}) / {k}.0::DOUBLE")
        for k in range(1, 5)
    ),
)
def m10_size_curve(spark, d):
    return rounded(blend.size_curve(scored(spark, d), "y", MODELS), 8)


_PAIRS = [(a, b) for i, a in enumerate(MODELS) for b in MODELS[i + 1 :]]


def _pair_sql(make: str) -> str:
    return f"WITH {SCORED} " + " UNION ALL ".join(
        f"SELECT '{a}' AS model_a, '{b}' AS model_b, round({make.format(a=a, b=b)}, 8) AS value FROM t" for a, b in _PAIRS
    )


@query("m11_correlation", _pair_sql("corr({a}, {b})"))
def m11_correlation(spark, d):
    return rounded(blend.pair_measures(scored(spark, d), MODELS), 8)


@query("m11_covariance", _pair_sql("covar_samp({a}, {b})"))
def m11_covariance(spark, d):
    return rounded(blend.pair_measures(scored(spark, d), MODELS, "covariance"), 8)


@query("m11_disagreement", _pair_sql("avg(CAST(({a} > 0.5) <> ({b} > 0.5) AS DOUBLE))"))
def m11_disagreement(spark, d):
    return rounded(blend.pair_measures(scored(spark, d), MODELS, "disagreement"), 8)


@query(
    "m11_average_diversity",
    f"WITH {SCORED} SELECT round(1 - ({' + '.join(f'corr({a}, {b})' for a, b in _PAIRS)}) / 6, 8) AS avg_diversity FROM t",
)
def m11_average_diversity(spark, d):
    return rounded(blend.diversity(scored(spark, d), MODELS), 8)


@query(
    "m12_select_diverse",
    f"""WITH {SCORED}, a AS (SELECT 'm_discount' AS m, corr(m_quantity, m_discount) AS c FROM t UNION ALL
        SELECT 'm_tax', corr(m_quantity, m_tax) FROM t UNION ALL SELECT 'm_line', corr(m_quantity, m_line) FROM t)
        SELECT 1 AS place, 'm_quantity' AS model UNION ALL SELECT 2, (SELECT m FROM a WHERE c < 0.95 ORDER BY 1 - c DESC LIMIT 1)""",
)
def m12_select_diverse(spark, d):
    chosen = blend.select_diverse(scored(spark, d), MODELS, n_select=2)
    return spark.createDataFrame([(i + 1, m) for i, m in enumerate(chosen)], "place int, model string")


@query(
    "v4_user_metric",
    f"WITH {SCORED} SELECT flag, round(quantile_cont(abs(y - m_quantity), 0.9), 6) AS score FROM t GROUP BY 1",
)
def v4_user_metric(spark, d):
    """A caller's own metric: any function of two columns that returns an aggregate."""
    out = metrics.score(
        scored(spark, d), "y", "m_quantity", lambda y, p: F.percentile(F.abs(y - p), F.lit(0.9)), ["flag"]
    )
    return rounded(out)


