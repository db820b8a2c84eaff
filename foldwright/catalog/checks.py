"""Leakage checks, feature selection, preparation and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import ORDERS, orders, query, rounded
from foldwright.operators import leakage, monitor, prep, select
from foldwright.sources.tables import table

_CUT = "TIMESTAMP '1997-01-01'"


def _early():
    return F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")


# ------------------------------------------------------------------- leakage

_LINE = "SELECT '{k}' AS \"check\", '{s}' AS subject, round({v}, 6) AS value, coalesce({t}, false) AS flagged FROM {f}"


def _target_sql(features: list[str], source: str, target: str) -> str:
    return " UNION ALL ".join(
        _LINE.format(k="target", s=c, v=f"corr({c}, {target})", t=f"abs(corr({c}, {target})) > 0.95", f=source)
        for c in features
    )


_L1_COLS = ["l_quantity", "l_discount", "l_tax", "twice_price"]


@query(
    "l1_target_leakage",
    "WITH t AS (SELECT *, l_extendedprice * 2 AS twice_price FROM lineitem) " + _target_sql(_L1_COLS, "t", "l_extendedprice"),
)
def l1_target_leakage(spark, d):
    rows = table(spark, d, "lineitem").withColumn("twice_price", F.col("l_extendedprice") * 2)
    return rounded(leakage.target_leakage(rows, "l_extendedprice", _L1_COLS))


_L2 = f"""(SELECT CAST(sum(n * m) AS DOUBLE) AS v FROM
  (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate < {_CUT} GROUP BY ALL)
  JOIN (SELECT o_custkey, o_orderpriority, count(*) AS m FROM orders WHERE o_orderdate >= {_CUT} GROUP BY ALL)
  USING (o_custkey, o_orderpriority)) d"""


@query("l2_duplicate_rows", _LINE.format(k="duplicates", s="rows", v="v", t="v > 0", f=_L2))
def l2_duplicate_rows(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    return rounded(leakage.duplicate_rows(rows.filter(_early()), rows.filter(~_early()), ["o_orderdate"]))


_L3 = """(SELECT count(*) FILTER (WHERE v = 0) / count(*) AS v FROM
  (SELECT o_custkey, var_samp(CAST(o_orderstatus = 'F' AS INTEGER)) AS v FROM orders GROUP BY 1)) d"""


@query("l3_group_leakage", _LINE.format(k="group", s="o_custkey", v="v", t="v > 0.9", f=_L3))
def l3_group_leakage(spark, d):
    return rounded(leakage.group_leakage(orders(spark, d), "o_custkey", "y"))


_AHEAD = """(SELECT corr(value, a) AS v FROM (SELECT value, CASE WHEN lead(1, 5) OVER (ORDER BY ts, event_id) IS NOT NULL
  THEN avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING) END AS a FROM events)) d"""


@query("l4_temporal_leakage", _LINE.format(k="temporal", s="value", v="v", t="v > 0.99", f=_AHEAD))
def l4_temporal_leakage(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts", "value")
    return rounded(leakage.temporal_leakage(rows, "ts", "event_id", ["value"], chunk_rows=1000))


_L5_AHEAD = """(SELECT corr(o_totalprice, a) AS v FROM (SELECT o_totalprice, CASE WHEN lead(1, 5) OVER w IS NOT NULL
  THEN avg(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING) END AS a
  FROM base WHERE o_orderdate < TIMESTAMP '1997-01-01' WINDOW w AS (ORDER BY o_orderdate, o_orderkey))) d"""
_L5 = f"WITH {ORDERS}, tr AS (SELECT * FROM base WHERE o_orderdate < {_CUT}) " + " UNION ALL ".join(
    [
        _target_sql(["o_totalprice"], "tr", "y"),
        _LINE.format(k="duplicates", s="rows", v="v", t="v > 0", f=_L2),
        _LINE.format(
            k="group", s="o_custkey", v="v", t="v > 0.9",
            f="(SELECT count(*) FILTER (WHERE v = 0) / count(*) AS v FROM (SELECT var_samp(y) AS v FROM tr GROUP BY o_custkey)) d",
        ),
        _LINE.format(k="temporal", s="o_totalprice", v="v", t="v > 0.99", f=_L5_AHEAD),
    ]
)


@query("l5_leakage_report", _L5)
def l5_leakage_report(spark, d):
    rows = orders(spark, d).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate", "y")
    train, test = rows.filter(_early()), rows.filter(~_early())
    out = leakage.leakage_report(
        train, test, target="y", group="o_custkey", time="o_orderdate", tie="o_orderkey",
        features=["o_totalprice"], exclude=["o_orderkey", "o_orderdate", "o_totalprice", "y"],
    )
    return rounded(out)


# ------------------------------------------------------------------ selection

_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _labelled(spark, d):
    y = (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 40000).cast("int")
    return table(spark, d, "lineitem").withColumn("y", y)


_LABELLED = "t AS (SELECT *, CAST(l_extendedprice * (1 - l_discount) > 40000 AS INTEGER) AS y FROM lineitem)"


def _anova_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 4) AS score
      FROM (SELECT y, count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v FROM t GROUP BY 1), (SELECT avg({c}) AS g FROM t)"""


@query("n1_anova_f", f"WITH {_LABELLED} " + " UNION ALL ".join(_anova_sql(c) for c in _FEATURES))
def n1_anova_f(spark, d):
    return rounded(select.anova_f(_labelled(spark, d), _FEATURES, "y"), 4)


def _mi_sql(c: str) -> str:
    edges = f"(SELECT list_distinct(quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM t)"
    return f"""SELECT '{c}' AS feature, round(sum(n / tot * ln(n * tot / (nb * nc))), 8) AS score FROM
      (SELECT n::DOUBLE AS n, sum(n) OVER () AS tot, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS nc FROM
       (SELECT (SELECT count(*) FROM unnest(e) u(x) WHERE x < {c}) AS b, y, count(*) AS n FROM t, {edges} GROUP BY ALL))"""


@query("n2_mutual_information", f"WITH {_LABELLED} " + " UNION ALL ".join(_mi_sql(c) for c in _FEATURES))
def n2_mutual_information(spark, d):
    return rounded(select.mutual_information(_labelled(spark, d), _FEATURES, "y"), 8)


@query("n3_forest_importance")
def n3_forest_importance(spark, d):
    return rounded(select.forest_importance(_labelled(spark, d), _FEATURES, "y", n_trees=20))


@query("n4_recursive_elimination")
def n4_recursive_elimination(spark, d):
    kept = select.eliminate(_labelled(spark, d), _FEATURES, "y", n_keep=2, n_trees=10)
    return spark.createDataFrame([(k,) for k in kept], "feature string")


def _score_table(spark, d):
    rows = _labelled(spark, d)
    scores = {
        "anova": select.anova_f(rows, _FEATURES, "y"),
        "mutual_info": select.mutual_information(rows, _FEATURES, "y"),
    }
    return select.score_table(scores)


_SCORES = (
    f"{_LABELLED}, s AS (SELECT 'anova' AS method, * FROM ("
    + " UNION ALL ".join(_anova_sql(c) for c in _FEATURES)
    + ") UNION ALL SELECT 'mutual_info', * FROM ("
    + " UNION ALL ".join(_mi_sql(c) for c in _FEATURES)
    + "))"
)
_VOTES = """v AS (SELECT feature, CAST(sum(CAST(score > m AS INTEGER)) AS BIGINT) AS votes FROM s
  JOIN (SELECT method, quantile_cont(score, 0.5) AS m FROM s GROUP BY 1) USING (method) GROUP BY 1)"""


@query("n5_feature_votes", f"WITH {_SCORES}, {_VOTES} SELECT * FROM v")
def n5_feature_votes(spark, d):
    return select.votes(_score_table(spark, d))


@query("t2_top_features", f"WITH {_SCORES}, {_VOTES} SELECT * FROM v ORDER BY votes DESC, feature LIMIT 2")
def t2_top_features(spark, d):
    return select.top_features(select.votes(_score_table(spark, d)), 2)


@query(
    "p5_select_features",
    f"""WITH {_SCORES}, {_VOTES} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount FROM lineitem
        WHERE (SELECT list(feature ORDER BY feature) FROM (SELECT feature FROM v ORDER BY votes DESC, feature LIMIT 2))
              = ['l_discount', 'l_extendedprice']""",
)
def p5_select_features(spark, d):
    best = [r["feature"] for r in select.top_features(select.votes(_score_table(spark, d)), 2).collect()]
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return prep.select_features(table(spark, d, "lineitem"), [*keys, *best])


@query("p6_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def p6_drop_columns(spark, d):
    return prep.drop_columns(table(spark, d, "orders"), ["o_orderstatus", "o_orderdate", "o_orderpriority"])


@query(
    "n6_importance_report",
    f"""WITH {_SCORES}, {_VOTES}, r AS (SELECT *, row_number() OVER (PARTITION BY method ORDER BY score DESC, feature) AS k FROM s)
    SELECT feature, CAST(max(k) FILTER (WHERE method = 'anova') AS INTEGER) AS anova_rank,
           CAST(max(k) FILTER (WHERE method = 'mutual_info') AS INTEGER) AS mutual_info_rank, 0 AS kept, any_value(votes) AS votes
    FROM r JOIN v USING (feature) GROUP BY 1""",
)
def n6_importance_report(spark, d):
    return select.importance_report(_score_table(spark, d))


def _chi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(sum(n) * (sum(n * n::DOUBLE / (rn * cn::DOUBLE)) - 1), 6) AS score,
      (count(DISTINCT v) - 1) * (count(DISTINCT y) - 1) AS degrees FROM
      (SELECT {c} AS v, y, count(*)::DOUBLE AS n, sum(count(*)) OVER (PARTITION BY {c}) AS rn, sum(count(*)) OVER (PARTITION BY y) AS cn
       FROM t GROUP BY 1, 2)"""


@query(
    "n7_chi_square",
    f"WITH {_LABELLED} " + " UNION ALL ".join(_chi_sql(c) for c in ("l_returnflag", "l_linestatus", "l_linenumber")),
)
def n7_chi_square(spark, d):
    return rounded(select.chi_square(_labelled(spark, d), ["l_returnflag", "l_linestatus", "l_linenumber"], "y"))


@query("n7_select_k_best")
def n7_select_k_best(spark, d):
    best = select.select_k_best(_labelled(spark, d), _FEATURES, "y", 2)
    return spark.createDataFrame([(b,) for b in best], "feature string")


# ---------------------------------------------------------------- preparation

_HOLES = """t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS q, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_tax END AS x FROM lineitem)"""
_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _holes(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("q"),
        F.when(F.col("l_linestatus") != "O", F.col("l_tax")).alias("x"),
    )


def _fill_sql(make: str) -> str:
    q, x = make.format(c="q"), make.format(c="x")
    return f"""WITH {_HOLES} SELECT {_IDS}, round(coalesce(q, (SELECT {q} FROM t)), 6) AS q,
      round(coalesce(x, (SELECT {x} FROM t)), 6) AS x FROM t"""


def _filled(spark, d, strategy, **options):
    rows = _holes(spark, d)
    return rounded(prep.impute(rows, prep.fit_impute(rows, ["q", "x"], strategy, **options)))


@query("f10_impute_median", _fill_sql("quantile_cont({c}, 0.5)"))
def f10_impute_median(spark, d):
    return _filled(spark, d, "median")


@query(
    "f10_impute_median_selected",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders)
       SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM t)), 6) AS o_totalprice FROM t""",
)
def f10_impute_median_selected(spark, d):
    """A column of nearly distinct values, where one buffer would not do."""
    price = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("o_totalprice")
    rows = table(spark, d, "orders").select("o_orderkey", price)
    return rounded(prep.impute(rows, prep.fit_impute(rows, ["o_totalprice"])))


@query("f10_impute_mean", _fill_sql("avg({c})"))
def f10_impute_mean(spark, d):
    return _filled(spark, d, "mean")


@query("f10_impute_mode", _fill_sql("first({c} ORDER BY n DESC, {c})").replace("FROM t)), 6) AS q", "FROM (SELECT q, count(*) AS n FROM t WHERE q IS NOT NULL GROUP BY 1))), 6) AS q").replace("FROM t)), 6) AS x", "FROM (SELECT x, count(*) AS n FROM t WHERE x IS NOT NULL GROUP BY 1))), 6) AS x"))
def f10_impute_mode(spark, d):
    return _filled(spark, d, "mode")


@query("f10_impute_constant", f"WITH {_HOLES} SELECT {_IDS}, coalesce(q, -999) AS q, coalesce(x, -999) AS x FROM t")
def f10_impute_constant(spark, d):
    return _filled(spark, d, "constant")


_IQR = """b AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS z FROM orders)"""


@query(
    "f11_outlier_flag",
    f"""WITH {_IQR} SELECT o_orderkey, CAST(NOT o_totalprice BETWEEN a - 0.2 * (z - a) AND z + 0.2 * (z - a) AS INTEGER)
        AS o_totalprice_outlier FROM orders, b""",
)
def f11_outlier_flag(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    bounds = prep.fit_outlier_bounds(rows, ["o_totalprice"], threshold=0.2)
    return prep.handle_outliers(rows, bounds, ["o_totalprice"]).drop("o_totalprice")


@query(
    "f11_outlier_clip",
    f"""WITH {_IQR} SELECT o_orderkey, round(least(greatest(o_totalprice, a - 0.2 * (z - a)), z + 0.2 * (z - a)), 6)
        AS o_totalprice FROM orders, b""",
)
def f11_outlier_clip(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    bounds = prep.fit_outlier_bounds(rows, ["o_totalprice"], threshold=0.2)
    return rounded(prep.handle_outliers(rows, bounds, ["o_totalprice"], "clip"))


@query(
    "f11_outlier_drop_zscore",
    """WITH b AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders)
       SELECT o_orderkey, o_totalprice FROM orders, b WHERE o_totalprice BETWEEN m - 1.5 * s AND m + 1.5 * s""",
)
def f11_outlier_drop_zscore(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    bounds = prep.fit_outlier_bounds(rows, ["o_totalprice"], "zscore")
    return prep.handle_outliers(rows, bounds, ["o_totalprice"], "drop")


@query(
    "f8_one_hot_standardise",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer)
       SELECT c_custkey, round((c_acctbal - m) / sd, 6) AS c_acctbal, """
    + ", ".join(
        f"CASE WHEN c_mktsegment = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"c_mktsegment_{v}\""
        for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer, s",
)
def f8_one_hot_standardise(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    coded = prep.one_hot_columns(rows, prep.fit_categories(rows, ["c_mktsegment"]))
    return rounded(prep.standardise(coded, prep.fit_scaler(rows, ["c_acctbal"]), ["c_acctbal"]))


@query(
    "f9_products",
    f"""SELECT {_IDS}, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount, round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax,
        round(l_discount * l_tax, 6) AS l_discount_x_l_tax FROM lineitem""",
)
def f9_products(spark, d):
    rows = table(spark, d, "lineitem")
    out = prep.products(rows, ["l_quantity", "l_discount", "l_tax"])
    made = [c for c in out.columns if "_x_" in c]
    return rounded(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *made))


def _narrow_sql() -> str:
    """The smallest type of each column, found from its values."""
    whole = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int"}
    limits = {"tinyint": 2**7, "smallint": 2**15, "int": 2**31}
    after = {
        c: "CASE " + " ".join(f"WHEN min({c}) >= -{n} AND max({c}) < {n} THEN '{t}'" for t, n in limits.items()) + " ELSE 'bigint' END"
        for c in whole
    }
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"):
        whole[c] = "double"
        after[c] = f"CASE WHEN bool_and(coalesce(CAST(CAST({c} AS FLOAT) AS DOUBLE) = {c}, true)) THEN 'float' ELSE 'double' END"
    for c, kind in (("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")):
        whole[c], after[c] = kind, f"'{kind}'"
    rows = [f"""SELECT '{c}' AS "column", '{kind}' AS before, {after[c]} AS after FROM lineitem{'' if '(' in after[c] else ' LIMIT 1'}""" for c, kind in whole.items()]
    return " UNION ALL ".join(f"SELECT * FROM ({r})" for r in rows)


@query("f17_narrow_types", _narrow_sql())
def f17_narrow_types(spark, d):
    return prep.narrow_types(table(spark, d, "lineitem"), floats=True)[1]


# ----------------------------------------------------------------- monitoring


@query(
    "d1_prediction_log",
    """SELECT event_id, 'm' AS model_name, '1' AS model_version, value / 500 AS prediction, value AS latency_ms,
       CAST(event_type = 'error' AS DOUBLE) AS actual, round(abs(value / 500 - CAST(event_type = 'error' AS DOUBLE)), 6) AS error,
       round((value + user_id) / 2, 6) AS feature_mean, round(abs(value - user_id) / 2, 6) AS feature_std,
       least(value, user_id) AS feature_min, greatest(value, user_id) AS feature_max FROM events""",
)
def d1_prediction_log(spark, d):
    out = prediction_log(spark, d)
    flat = [F.col(f"feature_stats.{s}").alias(f"feature_{s}") for s in ("mean", "std", "min", "max")]
    flat = [F.round(c, 6).alias(n) for c, n in zip(flat, ("feature_mean", "feature_std", "feature_min", "feature_max"))]
    keep = ["event_id", "model_name", "model_version", "prediction", "latency_ms", "actual", F.round("error", 6).alias("error")]
    return out.select(*keep, *flat)


def prediction_log(spark, d):
    rows = table(spark, d, "events").withColumns(
        {"p": F.col("value") / 500, "a": (F.col("event_type") == "error").cast("double")}
    )
    return monitor.log_rows(
        rows, "p", ["value", "user_id"], "m", "1", "ts", actual="a", latency_ms="value", keep=["event_id"]
    )


def _psi_sql(c: str) -> str:
    edges = f"(SELECT list_distinct(quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM a)"
    part = "SELECT (SELECT count(*) FROM unnest(e) u(x) WHERE x < {c}) AS b, count(*) / sum(count(*)) OVER () AS s FROM {t}, {e} GROUP BY 1"
    one, two = part.format(c=c, t="a", e=edges), part.format(c=c, t="z", e=edges)
    return f"""SELECT '{c}' AS feature, round(sum((c - r) * ln(c / r)), 6) AS psi, sum((c - r) * ln(c / r)) > 0.25 AS drift_detected FROM
      (SELECT greatest(coalesce(x.s, 0), 0.001) AS r, greatest(coalesce(y.s, 0), 0.001) AS c FROM ({one}) x FULL JOIN ({two}) y ON x.b = y.b)"""


@query(
    "d2_psi_drift",
    """WITH a AS (SELECT value, user_id * 1.0::DOUBLE AS user_id FROM events WHERE event_type <> 'error'),
       z AS (SELECT value * 1.5 AS value, user_id * 1.0::DOUBLE AS user_id FROM events WHERE event_type = 'error') """
    + _psi_sql("value") + " UNION ALL " + _psi_sql("user_id"),
)
def d2_psi_drift(spark, d):
    events = table(spark, d, "events")
    reference = events.filter("event_type <> 'error'")
    current = events.filter("event_type = 'error'").withColumn("value", F.col("value") * 1.5)
    return rounded(monitor.drift(reference, current, ["value", "user_id"]))


_D3 = """WITH t AS (SELECT value AS l, abs(value / 500 - CAST(event_type = 'error' AS DOUBLE)) AS e FROM events
  WHERE ts > TIMESTAMP '2024-01-20'), r AS (SELECT count(*) AS total_predictions, round(avg(l), 6) AS latency_mean,
  round(stddev_pop(l), 6) AS latency_std, round(avg(e), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
  round(quantile_cont(l, 0.5), 6) AS p50_ms, round(quantile_cont(l, 0.95), 6) AS p95_ms, round(quantile_cont(l, 0.99), 6) AS p99_ms FROM t)
  SELECT *{extra} FROM r"""


def _report(spark, d):
    return monitor.quality_report(prediction_log(spark, d), cutoff=F.lit("2024-01-20").cast("timestamp_ntz"))


@query("d3_quality_report", _D3.format(extra=""))
def d3_quality_report(spark, d):
    return rounded(_report(spark, d))


@query("d3_quality_report_selected", _D3.format(extra="").replace("WHERE ts > TIMESTAMP '2024-01-20'", ""))
def d3_quality_report_selected(spark, d):
    """The whole log."""
    return rounded(monitor.quality_report(prediction_log(spark, d)))


@query(
    "d4_alerts",
    _D3.format(
        extra=""", concat_ws(',', CASE WHEN p99_ms > 100 THEN 'latency' END, CASE WHEN 0.9 - mae > 0.05 THEN 'accuracy' END,
        CASE WHEN rmse > 0.01 THEN 'errors' END) AS alerts, false AS healthy"""
    ),
)
def d4_alerts(spark, d):
    report = _report(spark, d)
    out = monitor.alerts(report, accuracy=F.col("mae"), baseline_accuracy=0.9, error_rate=F.col("rmse"))
    return rounded(out)
