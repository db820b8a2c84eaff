"""Folds, time splits and samples on orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import ORDERS, dealt, orders, query
from foldwright.operators import splits
from foldwright.sources.tables import table

_KEY = "o_orderkey"


@query("c1_kfold", f"WITH {ORDERS}, f AS ({dealt('', _KEY, 'base')}) SELECT o_orderkey, fold FROM f")
def c1_kfold(spark, d):
    return splits.kfold(orders(spark, d).select(_KEY), _KEY).select(_KEY, "fold")


@query(
    "c1_kfold_unshuffled",
    """SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders""",
)
def c1_kfold_unshuffled(spark, d):
    return splits.kfold(orders(spark, d).select(_KEY), _KEY, shuffle=False).select(_KEY, "fold")


@query(
    "c1_hash_fold",
    """SELECT o_orderkey, CAST(CAST('0x' || substr(md5(concat_ws('_', '42', CAST(o_orderkey AS VARCHAR))), 1, 8)
       AS BIGINT) % 5 AS INTEGER) AS fold FROM orders""",
)
def c1_hash_fold(spark, d):
    return splits.kfold(orders(spark, d).select(_KEY), _KEY, exact=False).select(_KEY, "fold")


@query("c2_stratified_kfold", f"WITH {ORDERS}, f AS ({dealt('y', _KEY, 'base')}) SELECT o_orderkey, y, fold FROM f")
def c2_stratified_kfold(spark, d):
    return splits.stratified_kfold(orders(spark, d).select(_KEY, "y"), _KEY, "y").select(_KEY, "y", "fold")


@query(
    "c3_group_kfold",
    """WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
       r AS (SELECT o_custkey, (row_number() OVER (ORDER BY n DESC, o_custkey) - 1) % 10 AS t FROM g)
       SELECT o_orderkey, o_custkey, CAST(CASE WHEN t < 5 THEN t ELSE 9 - t END AS INTEGER) AS fold
       FROM orders JOIN r USING (o_custkey)""",
)
def c3_group_kfold(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_custkey")
    return splits.group_kfold(rows, "o_custkey").select(_KEY, "o_custkey", "fold")


_POSITION = "SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS index, count(*) OVER () AS n FROM orders"


@query(
    "c4_time_split",
    f"""WITH p AS ({_POSITION}), s AS (SELECT unnest(range(5)) AS split),
        e AS (SELECT o_orderkey, index, split, n - (5 - split) * (n // 6) AS start, n // 6 AS size FROM p, s)
        SELECT o_orderkey, CAST(split AS INTEGER) AS split,
               CASE WHEN index < start THEN 'train' ELSE 'test' END AS role
        FROM e WHERE index < start + size""",
)
def c4_time_split(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_orderdate")
    return splits.time_split(rows, "o_orderdate", _KEY).select(_KEY, "split", "role")


@query(
    "c5_purged_split",
    f"""WITH p AS ({_POSITION}), s AS (SELECT unnest(range(5)) AS split),
        b AS (SELECT o_orderkey, index, split, n, split * (n // 5) AS a,
                     CASE WHEN split = 4 THEN n ELSE (split + 1) * (n // 5) END AS z FROM p, s),
        e AS (SELECT *, CAST(floor((z - a) * 0.01) AS BIGINT) AS emb FROM b)
        SELECT o_orderkey, CAST(split AS INTEGER) AS split,
               CASE WHEN index >= a AND index < z THEN 'test' ELSE 'train' END AS role
        FROM e WHERE (index >= a AND index < z) OR index < a - 20 OR index >= z + 20 + emb""",
)
def c5_purged_split(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_orderdate")
    out = splits.purged_split(rows, "o_orderdate", _KEY, purge_gap=20, embargo_pct=0.01)
    return out.select(_KEY, "split", "role")


@query(
    "c5_purged_split_legacy",
    f"""WITH p AS ({_POSITION}), s AS (SELECT unnest(range(5)) AS split),
        b AS (SELECT o_orderkey, index, n, split,
                     split * (n // 5) + CAST(floor((n // 5) * 0.01) AS BIGINT) AS a, (split + 1) * (n // 5) AS z FROM p, s)
        SELECT o_orderkey, CAST(split AS INTEGER) AS split,
               CASE WHEN index >= a AND index < z THEN 'test' ELSE 'train' END AS role
        FROM b WHERE (index >= a AND index < z) OR index < a - 20 OR index >= z + 20""",
)
def c5_purged_split_legacy(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_orderdate")
    out = splits.purged_split(rows, "o_orderdate", _KEY, purge_gap=20, embargo_pct=0.01, legacy=True)
    return out.select(_KEY, "split", "role")


@query(
    "c6_purged_forward_split",
    f"""WITH p AS ({_POSITION}), s AS (SELECT unnest(range(5)) AS split),
        b AS (SELECT o_orderkey, index, n, split, (split + 1) * (n // 6) AS a,
                     CASE WHEN split = 4 THEN n ELSE (split + 2) * (n // 6) END AS z FROM p, s),
        e AS (SELECT *, z - CAST(floor((z - a) * 0.01) AS BIGINT) AS z2 FROM b)
        SELECT o_orderkey, CAST(split AS INTEGER) AS split,
               CASE WHEN index >= a THEN 'test' ELSE 'train' END AS role
        FROM e WHERE (index >= a AND index < z2) OR index < a - 20""",
)
def c6_purged_forward_split(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_orderdate")
    return splits.purged_forward_split(rows, "o_orderdate", _KEY, purge_gap=20).select(_KEY, "split", "role")


@query(
    "c7_stratified_group_kfold",
    f"""WITH {ORDERS}, c AS (SELECT o_custkey, y, count(*) AS n FROM base GROUP BY 1, 2),
        m AS (SELECT o_custkey, first(y ORDER BY n DESC, y) AS majority FROM c GROUP BY 1),
        r AS (SELECT o_custkey, CAST((row_number() OVER (ORDER BY majority, o_custkey) - 1) % 5 AS INTEGER) AS fold FROM m)
        SELECT o_orderkey, o_custkey, fold FROM base JOIN r USING (o_custkey)""",
)
def c7_stratified_group_kfold(spark, d):
    rows = orders(spark, d).select(_KEY, "o_custkey", "y")
    return splits.stratified_group_kfold(rows, "o_custkey", "y").select(_KEY, "o_custkey", "fold")


@query(
    "x1_exact_sample",
    """SELECT o_orderkey FROM orders QUALIFY row_number() OVER
       (ORDER BY md5(concat_ws('_', '7', CAST(o_orderkey AS VARCHAR))), o_orderkey)
       <= floor(count(*) OVER () * 0.3)""",
)
def x1_exact_sample(spark, d):
    return splits.exact_sample(table(spark, d, "orders").select(_KEY), _KEY, 0.3, seed=7)


_U = """(CAST(CAST('0x' || substr(md5(concat_ws('_', '42_bag', CAST(o_orderkey AS VARCHAR))), 1, 13) AS BIGINT) AS DOUBLE)
        + 0.5) / 4503599627370496.0"""
_POISSON = " + ".join(
    f"CASE WHEN u > {sum(0.36787944117144233 / __import__('math').factorial(j) for j in range(k + 1))!r} THEN 1 ELSE 0 END"
    for k in range(12)
)


@query(
    "x2_bootstrap_bag",
    f"WITH u AS (SELECT o_orderkey, {_U} AS u FROM orders) SELECT o_orderkey, {_POISSON} AS copies FROM u WHERE ({_POISSON}) > 0",
)
def x2_bootstrap_bag(spark, d):
    return splits.bootstrap(table(spark, d, "orders").select(_KEY), _KEY)


@query(
    "x2_feature_bag",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem""",
)
def x2_feature_bag(spark, d):
    numeric = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = table(spark, d, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *splits.feature_bag(numeric, 0.5))


@query(
    "p14_holdout",
    f"""WITH {ORDERS}, r AS (SELECT o_orderkey, y, count(*) OVER (PARTITION BY y) AS n, row_number() OVER
        (PARTITION BY y ORDER BY md5(concat_ws('_', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS k FROM base)
        SELECT o_orderkey, y, CASE WHEN k <= ceil(0.2 * n) THEN 'valid' ELSE 'train' END AS role FROM r""",
)
def p14_holdout(spark, d):
    return splits.holdout(orders(spark, d).select(_KEY, "y"), _KEY, "y").select(_KEY, "y", "role")


@query(
    "c_default_strategy",
    """WITH g AS (SELECT count(DISTINCT o_custkey) AS n_groups FROM orders)
       SELECT n_groups, 'grouped' AS strategy, CAST(least(5, n_groups) AS INTEGER) AS n_folds FROM g""",
)
def c_default_strategy(spark, d):
    groups = table(spark, d, "orders").agg(F.count_distinct("o_custkey").alias("n_groups"))
    strategy, folds = splits.choose_strategy(group="o_custkey", n_groups=groups.first()[0])
    return groups.select("n_groups", F.lit(strategy).alias("strategy"), F.lit(folds).alias("n_folds"))
