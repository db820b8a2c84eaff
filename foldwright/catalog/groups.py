"""Group aggregates and stacked features."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import ORDERS, orders, query, rounded
from foldwright.operators import deep, groupby
from foldwright.sources.tables import table

_SQL_STAT = {
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "max": "max({c})",
    "median": "quantile_cont({c}, 0.5)",
    "count": "count({c})",
    "nunique": "count(DISTINCT {c})",
    "sum": "sum({c})",
    "skew": "skewness({c})",
}


def _stat(stat: str, col: str, name: str) -> str:
    made = _SQL_STAT[stat].format(c=col)
    return f"{made} AS {name}" if stat in ("count", "nunique") else f"round({made}, 6) AS {name}"


_A1_STATS = ("mean", "std", "min", "max", "median", "count", "nunique")
_A1 = f"""WITH g AS (SELECT o_custkey, {", ".join(_stat(s, "o_totalprice", f"o_totalprice_{s}_by_o_custkey") for s in _A1_STATS)},
    avg(o_totalprice) AS m, quantile_cont(o_totalprice, 0.5) AS md FROM orders GROUP BY 1)
  SELECT o_orderkey, g.* EXCLUDE (m, md), round(o_totalprice - m, 6) AS o_totalprice_diff_from_mean_by_o_custkey,
    round(o_totalprice - md, 6) AS o_totalprice_diff_from_median_by_o_custkey,
    round(o_totalprice / (m + 1e-8), 6) AS o_totalprice_ratio_to_mean_by_o_custkey,
    round(o_totalprice / (md + 1e-8), 6) AS o_totalprice_ratio_to_median_by_o_custkey
  FROM orders JOIN g USING (o_custkey)"""


@query("a1_group_features", _A1)
def a1_group_features(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rounded(groupby.group_features(rows, "o_custkey", ["o_totalprice"]).drop("o_totalprice"))


@query("a1_group_features_hot_split", _A1)
def a1_group_features_hot_split(spark, d):
    """The same with every customer above 10 orders treated as a hot key."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = groupby.group_features(rows, "o_custkey", ["o_totalprice"], hot_rows=10)
    return rounded(out.drop("o_totalprice"))


@query(
    "a2_basic_stats",
    f"""SELECT l_suppkey, {", ".join(_stat(s, c, f"{c}_{s}_by_l_suppkey") for c in ("l_quantity", "l_extendedprice")
        for s in ("mean", "std", "min", "max", "sum"))} FROM lineitem GROUP BY 1""",
)
def a2_basic_stats(spark, d):
    out = groupby.group_stats(
        table(spark, d, "lineitem"), "l_suppkey", ["l_quantity", "l_extendedprice"],
        ["mean", "std", "min", "max", "sum"], lambda c, s: f"{c}_{s}_by_l_suppkey",
    )
    return rounded(out.drop("__fw_n"))


_A3 = """SELECT l_partkey, round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice_median,
         round(quantile_cont(l_quantity, 0.5), 6) AS l_quantity_median FROM lineitem GROUP BY 1"""


@query("a3_median", _A3)
def a3_median(spark, d):
    out = groupby.group_stats(
        table(spark, d, "lineitem"), "l_partkey", ["l_extendedprice", "l_quantity"], ["median"], lambda c, s: f"{c}_{s}"
    )
    return rounded(out.drop("__fw_n"))


@query("a3_median_hot_split", _A3)
def a3_median_hot_split(spark, d):
    """Medians of parts with more than 30 lines by rank selection instead of one buffer."""
    out = groupby.group_stats(
        table(spark, d, "lineitem"), "l_partkey", ["l_extendedprice", "l_quantity"], ["median"],
        lambda c, s: f"{c}_{s}", hot_rows=30,
    )
    return rounded(out.drop("__fw_n"))


_GAPS = "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END"


@query(
    "a4_count",
    f"SELECT l_suppkey, count({_GAPS}) AS quantity_count FROM lineitem GROUP BY 1",
)
def a4_count(spark, d):
    rows = table(spark, d, "lineitem").withColumn("quantity", F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
    return groupby.group_stats(rows, "l_suppkey", ["quantity"], ["count"], lambda c, s: f"{c}_{s}").drop("__fw_n")


@query(
    "a5_nunique",
    f"""SELECT l_suppkey, count(DISTINCT {_GAPS}) AS quantity_nunique, count(DISTINCT l_partkey) AS l_partkey_nunique
        FROM lineitem GROUP BY 1""",
)
def a5_nunique(spark, d):
    rows = table(spark, d, "lineitem").withColumn("quantity", F.when(F.col("l_returnflag") != "N", F.col("l_quantity")))
    out = groupby.group_stats(rows, "l_suppkey", ["quantity", "l_partkey"], ["nunique"], lambda c, s: f"{c}_{s}")
    return out.drop("__fw_n")


@query(
    "a6_skew",
    "SELECT l_partkey, round(skewness(l_extendedprice), 5) AS l_extendedprice_skew FROM lineitem GROUP BY 1",
)
def a6_skew(spark, d):
    out = groupby.group_stats(table(spark, d, "lineitem"), "l_partkey", ["l_extendedprice"], ["skew"], lambda c, s: f"{c}_{s}")
    return rounded(out.drop("__fw_n"), 5)


@query(
    "a7_mode",
    """WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)
       SELECT l_suppkey, first(l_quantity ORDER BY n DESC, l_quantity) AS l_quantity_mode FROM c GROUP BY 1""",
)
def a7_mode(spark, d):
    return groupby.group_mode(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity")


@query(
    "a8_hierarchical",
    """WITH a AS (SELECT o_orderstatus, round(avg(o_totalprice), 6) AS o_totalprice_mean_by_o_orderstatus FROM orders GROUP BY 1),
       b AS (SELECT o_orderstatus, o_orderpriority, avg(o_totalprice) AS m FROM orders GROUP BY 1, 2)
       SELECT o_orderkey, round(m, 6) AS o_totalprice_mean_by_o_orderstatus_o_orderpriority, o_totalprice_mean_by_o_orderstatus
       FROM orders JOIN a USING (o_orderstatus) JOIN b USING (o_orderstatus, o_orderpriority)""",
)
def a8_hierarchical(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    out = groupby.group_features(
        rows, ["o_orderstatus", "o_orderpriority"], ["o_totalprice"], ["mean"], diff=False, ratios=False, hierarchical=True
    )
    return rounded(out.drop("o_orderstatus", "o_orderpriority", "o_totalprice"))


@query(
    "a9_basic_group_features",
    f"""WITH g AS (SELECT o_custkey, {", ".join(_stat(s, "o_totalprice", f"o_totalprice_{s}_by_o_custkey") for s in ("mean", "std", "min", "max"))},
        avg(o_totalprice) AS m FROM orders GROUP BY 1)
        SELECT o_orderkey, g.* EXCLUDE (m), round(o_totalprice - m, 6) AS o_totalprice_diff_from_mean_by_o_custkey,
        round(o_totalprice / (m + 1e-8), 6) AS o_totalprice_ratio_to_mean_by_o_custkey FROM orders JOIN g USING (o_custkey)""",
)
def a9_basic_group_features(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rounded(groupby.basic_group_features(rows, "o_custkey", ["o_totalprice"]).drop("o_totalprice"))


@query(
    "a9_mean_std_features",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER w, 6) AS o_totalprice_mean,
       round(stddev_samp(o_totalprice) OVER w, 6) AS o_totalprice_std FROM orders WINDOW w AS (PARTITION BY o_custkey)""",
)
def a9_mean_std_features(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = groupby.mean_std_features(rows, "o_custkey", ["o_totalprice"])
    return rounded(out.select("o_orderkey", "o_totalprice_mean", "o_totalprice_std"))


_A10 = ("mean", "std", "min", "max", "count", "median", "skew", "sum")


@query(
    "a10_prefixed_group_features",
    f"""WITH g AS (SELECT o_custkey, {", ".join(_stat(s, "o_totalprice", f"o_custkey_o_totalprice_{s}") for s in _A10)},
        avg(o_totalprice) AS m FROM orders GROUP BY 1)
        SELECT o_orderkey, g.* EXCLUDE (m), round(o_totalprice / (m + 1e-8), 6) AS o_totalprice_to_o_custkey_mean_ratio,
        round(o_totalprice - m, 6) AS o_totalprice_minus_o_custkey_mean FROM orders JOIN g USING (o_custkey)""",
)
def a10_prefixed_group_features(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rounded(groupby.prefixed_group_features(rows, "o_custkey", "o_totalprice", _A10).drop("o_totalprice"))


@query(
    "a12_deep_features",
    """WITH lo AS (SELECT l_orderkey, avg(l_quantity) AS mean_lines_l_quantity, max(l_quantity) AS max_lines_l_quantity,
           sum(l_quantity) AS sum_lines_l_quantity, count(*) AS c FROM lineitem GROUP BY 1),
       mc AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
       mo AS (SELECT l_orderkey, first(l_returnflag ORDER BY n DESC, l_returnflag) AS m FROM mc GROUP BY 1),
       o AS (SELECT o_custkey, o_orderkey, o_totalprice, mean_lines_l_quantity AS a, max_lines_l_quantity AS b,
                    sum_lines_l_quantity AS s, coalesce(c, 0) AS c, m
             FROM orders LEFT JOIN lo ON l_orderkey = o_orderkey LEFT JOIN mo ON mo.l_orderkey = o_orderkey),
       pc AS (SELECT o_custkey, m, count(*) AS n FROM o WHERE m IS NOT NULL GROUP BY 1, 2),
       pm AS (SELECT o_custkey, first(m ORDER BY n DESC, m) AS mode_orders_mode_lines_l_returnflag FROM pc GROUP BY 1),
       g AS (SELECT o_custkey, count(*) AS n, round(avg(o_totalprice), 6) AS mean_orders_o_totalprice,
           round(stddev_samp(o_totalprice), 6) AS std_orders_o_totalprice, round(skewness(o_totalprice), 6) AS skew_orders_o_totalprice,
           round(avg(s), 6) AS mean_orders_sum_lines_l_quantity, round(stddev_samp(s), 6) AS std_orders_sum_lines_l_quantity,
           round(skewness(s), 6) AS skew_orders_sum_lines_l_quantity,
           round(avg(c), 6) AS mean_orders_count_lines, round(stddev_samp(c), 6) AS std_orders_count_lines,
           round(skewness(c), 6) AS skew_orders_count_lines FROM o GROUP BY 1)
       SELECT c_custkey, coalesce(n, 0) AS count_orders, g.* EXCLUDE (o_custkey, n), mode_orders_mode_lines_l_returnflag,
              round(c_acctbal * mean_orders_o_totalprice_raw, 0) AS c_acctbal_times_mean_orders_o_totalprice
       FROM customer LEFT JOIN g ON g.o_custkey = c_custkey LEFT JOIN pm ON pm.o_custkey = c_custkey
       LEFT JOIN (SELECT o_custkey, avg(o_totalprice) AS mean_orders_o_totalprice_raw FROM o GROUP BY 1) r ON r.o_custkey = c_custkey""",
)
def a12_deep_features(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    parents = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    level_one, made = deep.roll_up(
        lines, parents, "l_orderkey", "o_orderkey", "lines", ["l_quantity"], ["l_returnflag"], ["sum", "count", "mode"]
    )
    numeric = ["o_totalprice", "sum_lines_l_quantity", "count_lines"]
    people = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    level_two, more = deep.roll_up(
        level_one, people, "o_custkey", "c_custkey", "orders", numeric, ["mode_lines_l_returnflag"],
        ["mean", "std", "skew", "count", "mode"],
    )
    out, crossed = deep.pairwise_transforms(level_two, ["c_acctbal", "mean_orders_o_totalprice"], ["multiply"])
    product = F.round(crossed[0], 0).alias(crossed[0])
    return rounded(out.select("c_custkey", *more), 6).join(out.select("c_custkey", product), "c_custkey")


@query(
    "a12_difference",
    """SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS diff_value,
       round(abs(value), 6) AS absolute_value, round(value + user_id, 6) AS value_plus_user_id FROM events""",
)
def a12_difference(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    moved = deep.difference(rows, "user_id", "ts", "event_id", "value")
    out, _ = deep.pairwise_transforms(moved, ["value", "user_id"], ["absolute", "add"])
    return rounded(out.select("event_id", "diff_value", "absolute_value", "value_plus_user_id"))


@query(
    "a14_majority_class",
    f"""WITH {ORDERS}, c AS (SELECT o_custkey, y, count(*) AS n FROM base GROUP BY 1, 2)
        SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n_rows, count(y) AS n_classes, first(y ORDER BY n DESC, y) AS majority
        FROM c GROUP BY 1""",
)
def a14_majority_class(spark, d):
    return groupby.majority_class(orders(spark, d), "o_custkey", "y")


@query("a14_class_counts", f"WITH {ORDERS} SELECT o_custkey, y, count(*) AS n FROM base GROUP BY 1, 2")
def a14_class_counts(spark, d):
    return groupby.class_counts(orders(spark, d), "o_custkey", "y")


@query(
    "a15_distinct_counts",
    f"""WITH {ORDERS} SELECT count(DISTINCT y) AS n_y, count(DISTINCT o_custkey) AS n_o_custkey,
        count(DISTINCT o_orderpriority) AS n_o_orderpriority FROM base""",
)
def a15_distinct_counts(spark, d):
    return groupby.distinct_counts(orders(spark, d), ["y", "o_custkey", "o_orderpriority"])


@query(
    "a16_class_centroids",
    """SELECT label, CAST(i AS INTEGER) AS position, round(avg(CAST(embedding[i + 1] AS DOUBLE)), 6) AS mean
       FROM embeddings, range(64) r(i) GROUP BY 1, 2""",
)
def a16_class_centroids(spark, d):
    return rounded(groupby.centroids(table(spark, d, "embeddings"), "label", vector="embedding"))


@query(
    "p2_numeric_columns",
    """SELECT s_nationkey, round(avg(s_suppkey), 6) AS s_suppkey_mean, round(avg(s_acctbal), 6) AS s_acctbal_mean
       FROM supplier GROUP BY 1""",
)
def p2_numeric_columns(spark, d):
    from foldwright.functions.scalars import numeric_columns

    rows = table(spark, d, "supplier")
    found = numeric_columns(rows, ["s_nationkey"])
    out = groupby.group_stats(rows, "s_nationkey", found, ["mean"], lambda c, s: f"{c}_{s}")
    return rounded(out.drop("__fw_n"))


_TWO_KEYS = """WITH g AS (SELECT l_suppkey, l_returnflag, avg(l_discount) AS m, median(l_discount) AS md FROM lineitem GROUP BY 1, 2)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount {op} {b}, 6) AS {name}
  FROM lineitem JOIN g USING (l_suppkey, l_returnflag)"""


def _two_keys(spark, d, **options):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_discount"
    )
    return groupby.group_features(rows, ["l_suppkey", "l_returnflag"], ["l_discount"], ["mean", "median"], **options)


_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "p7_difference",
    _TWO_KEYS.format(op="- ", b="m", name="l_discount_diff_from_mean_by_l_suppkey_l_returnflag"),
)
def p7_difference(spark, d):
    return rounded(_two_keys(spark, d, ratios=False).select(*_IDS, "l_discount_diff_from_mean_by_l_suppkey_l_returnflag"))


@query(
    "p8_ratio",
    _TWO_KEYS.format(op="/ ", b="(md + 1e-8)", name="l_discount_ratio_to_median_by_l_suppkey_l_returnflag"),
)
def p8_ratio(spark, d):
    return rounded(_two_keys(spark, d, diff=False).select(*_IDS, "l_discount_ratio_to_median_by_l_suppkey_l_returnflag"))


@query(
    "j1_aggregate_join",
    """WITH g AS (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1)
       SELECT c_custkey, n_orders, spent FROM customer LEFT JOIN g ON o_custkey = c_custkey""",
)
def j1_aggregate_join(spark, d):
    from foldwright.plans.hot import attach

    spent = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    return attach(table(spark, d, "customer").select("c_custkey"), spent, ["c_custkey"])


@query(
    "j1_hot_key_join",
    """WITH g AS (SELECT l_suppkey, round(avg(l_quantity), 6) AS m FROM lineitem GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, m FROM lineitem JOIN g USING (l_suppkey)""",
)
def j1_hot_key_join(spark, d):
    """Suppliers above 600 lines count as hot: their state is broadcast, their rows salted."""
    from foldwright.plans.hot import attach

    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    state = rows.groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 6).alias("m"))
    return attach(rows.drop("l_quantity"), state, ["l_suppkey"], hot_rows=600)


@query(
    "j2_lookup_default",
    """WITH s AS (SELECT p_brand, round(avg(p_retailprice), 6) AS v FROM part WHERE p_size > 40 GROUP BY 1)
       SELECT p_partkey, coalesce(v, -1.0) AS v FROM part LEFT JOIN s USING (p_brand)""",
)
def j2_lookup_default(spark, d):
    from foldwright.plans.hot import attach

    parts = table(spark, d, "part")
    state = parts.filter("p_size > 40").groupBy("p_brand").agg(F.round(F.avg("p_retailprice"), 6).alias("v"))
    out = attach(parts.select("p_partkey", "p_brand"), state, ["p_brand"])
    return out.select("p_partkey", F.coalesce("v", F.lit(-1.0)).alias("v"))


@query(
    "j3_multi_key_lookup",
    """WITH s AS (SELECT p_brand, p_type, round(avg(p_retailprice), 6) AS v FROM part WHERE p_size > 40 GROUP BY 1, 2)
       SELECT p_partkey, coalesce(v, -1.0) AS v FROM part LEFT JOIN s USING (p_brand, p_type)""",
)
def j3_multi_key_lookup(spark, d):
    from foldwright.plans.hot import attach

    parts = table(spark, d, "part")
    state = parts.filter("p_size > 40").groupBy("p_brand", "p_type").agg(F.round(F.avg("p_retailprice"), 6).alias("v"))
    out = attach(parts.select("p_partkey", "p_brand", "p_type"), state, ["p_brand", "p_type"])
    return out.select("p_partkey", F.coalesce("v", F.lit(-1.0)).alias("v"))


@query(
    "j6_global_statistic",
    "SELECT o_orderkey, round(o_totalprice - (SELECT avg(o_totalprice) FROM orders), 4) AS above FROM orders",
)
def j6_global_statistic(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    mean = rows.agg(F.avg("o_totalprice").alias("m"))
    return rows.crossJoin(F.broadcast(mean)).select("o_orderkey", F.round(F.col("o_totalprice") - F.col("m"), 4).alias("above"))
