"""Encoders on orders: high-cardinality customer, low-cardinality priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import FOLDED, ORDERS, orders, query, rounded
from foldwright.operators import encode, splits
from foldwright.sources.tables import table

_KEY = "o_orderkey"
_CATS = ["o_custkey", "o_orderpriority"]


def folded(spark, d):
    rows = orders(spark, d).select(_KEY, *_CATS, "o_totalprice", "o_orderdate", "y")
    return splits.stratified_kfold(rows, _KEY, "y")


def _oof_value(cat: str, s: float = 10.0, leaf: int = 1, prior: str = "g.g", k: str = "a") -> str:
    rest_n = f"({k}.n - {k}f.n)"
    return (
        f"CASE WHEN {rest_n} >= {max(leaf, 1)} THEN (({k}.t - {k}f.t) + {s} * {prior}) / ({rest_n} + {s}) ELSE {prior} END"
    )


def _oof_sql(select: str) -> str:
    return f"""WITH {FOLDED},
    g AS (SELECT fold, (sum(sum(y)) OVER () - sum(y)) / (sum(count(*)) OVER () - count(*)) AS g,
                 sum(sum(y)) OVER () / sum(count(*)) OVER () AS g_all FROM folded GROUP BY fold),
    a AS (SELECT o_custkey, sum(y) AS t, count(*) AS n FROM folded GROUP BY 1),
    af AS (SELECT o_custkey, fold, sum(y) AS t, count(*) AS n FROM folded GROUP BY 1, 2),
    b AS (SELECT o_orderpriority, sum(y) AS t, count(*) AS n FROM folded GROUP BY 1),
    bf AS (SELECT o_orderpriority, fold, sum(y) AS t, count(*) AS n FROM folded GROUP BY 1, 2)
    SELECT o_orderkey, {select} FROM folded JOIN g USING (fold) JOIN a USING (o_custkey)
    JOIN af USING (o_custkey, fold) JOIN b USING (o_orderpriority) JOIN bf USING (o_orderpriority, fold)"""


@query(
    "e1_target_fit",
    f"""WITH {ORDERS}, g AS (SELECT avg(y) AS g FROM base),
    s AS (SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS category, sum(y) AS t, count(*) AS n FROM base GROUP BY 2
          UNION ALL SELECT 'o_orderpriority', o_orderpriority, sum(y), count(*) FROM base GROUP BY 2)
    SELECT "column", category, n, round((t + 10 * g) / (n + 10), 6) AS value FROM s, g
    UNION ALL SELECT '__all__', '', count(*), round(avg(y), 6) FROM base""",
)
def e1_target_fit(spark, d):
    return rounded(encode.fit_target(orders(spark, d), _CATS, "y"))


@query(
    "e2_oof_target_encode",
    _oof_sql(
        f"fold, round({_oof_value('o_custkey')}, 6) AS o_custkey_target_enc, "
        f"round({_oof_value('o_orderpriority', k='b')}, 6) AS o_orderpriority_target_enc"
    ),
)
def e2_oof_target_encode(spark, d):
    out = encode.oof_target_encode(folded(spark, d), _CATS, "y")
    return rounded(out.select(_KEY, "fold", *[f"{c}_target_enc" for c in _CATS]))


@query(
    "e2_oof_min_samples_leaf",
    _oof_sql(f"round({_oof_value('o_custkey', 2.0, 8)}, 6) AS o_custkey_target_enc"),
)
def e2_oof_min_samples_leaf(spark, d):
    out = encode.oof_target_encode(folded(spark, d), "o_custkey", "y", smoothing=2.0, min_samples_leaf=8)
    return rounded(out.select(_KEY, "o_custkey_target_enc"))


_TRAIN = "o_orderdate < TIMESTAMP '1997-01-01'"


@query(
    "e3_target_transform",
    f"""WITH {ORDERS}, tr AS (SELECT * FROM base WHERE {_TRAIN}), g AS (SELECT avg(y) AS g FROM tr),
    a AS (SELECT o_custkey, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM tr, g GROUP BY 1),
    b AS (SELECT o_orderpriority, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM tr, g GROUP BY 1)
    SELECT o_orderkey, round(coalesce(a.v, g), 6) AS o_custkey_target_enc,
           round(coalesce(b.v, g), 6) AS o_orderpriority_target_enc
    FROM base CROSS JOIN g LEFT JOIN a USING (o_custkey) LEFT JOIN b USING (o_orderpriority) WHERE NOT ({_TRAIN})""",
)
def e3_target_transform(spark, d):
    rows = orders(spark, d)
    train = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    state = encode.fit_target(rows.filter(train), _CATS, "y")
    unseen = rows.filter(~train).select(_KEY, *_CATS)
    return rounded(encode.apply_target(unseen, state, _CATS, keep=[_KEY]))


@query(
    "e5_oof_global_prior",
    _oof_sql(f"round({_oof_value('o_custkey', prior='g.g_all')}, 6) AS o_custkey"),
)
def e5_oof_global_prior(spark, d):
    out = encode.oof_target_encode(folded(spark, d), "o_custkey", "y", prior="all", replace=True)
    return rounded(out.select(_KEY, "o_custkey"))


@query(
    "e6_group_target",
    f"""WITH {ORDERS}, g AS (SELECT avg(y) AS g FROM base),
    a AS (SELECT o_custkey, o_orderpriority, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v FROM base, g GROUP BY 1, 2)
    SELECT o_orderkey, round(v, 6) AS y_encoded_by_o_custkey_o_orderpriority
    FROM base JOIN a USING (o_custkey, o_orderpriority)""",
)
def e6_group_target(spark, d):
    out = encode.group_target(orders(spark, d), _CATS, "y")
    return rounded(out.select(_KEY, "y_encoded_by_o_custkey_o_orderpriority"))


@query(
    "e6_group_target_oof",
    f"""WITH {FOLDED},
    g AS (SELECT fold, (sum(sum(y)) OVER () - sum(y)) / (sum(count(*)) OVER () - count(*)) AS g FROM folded GROUP BY fold),
    a AS (SELECT o_custkey, o_orderpriority, sum(y) AS t, count(*) AS n FROM folded GROUP BY 1, 2),
    af AS (SELECT o_custkey, o_orderpriority, fold, sum(y) AS t, count(*) AS n FROM folded GROUP BY 1, 2, 3)
    SELECT o_orderkey, round({_oof_value('x')}, 6) AS y_encoded_by_o_custkey_o_orderpriority
    FROM folded JOIN g USING (fold) JOIN a USING (o_custkey, o_orderpriority)
    JOIN af USING (o_custkey, o_orderpriority, fold)""",
)
def e6_group_target_oof(spark, d):
    out = encode.group_target(folded(spark, d), _CATS, "y", fold="fold")
    return rounded(out.select(_KEY, "y_encoded_by_o_custkey_o_orderpriority"))


@query(
    "e7_count_encode",
    f"""WITH {ORDERS}, tr AS (SELECT * FROM base WHERE {_TRAIN}),
    a AS (SELECT o_custkey, count(*) AS v FROM tr GROUP BY 1 HAVING count(*) >= 3),
    m AS (SELECT min(v) AS low FROM a), p AS (SELECT o_orderpriority, count(*) AS v FROM tr GROUP BY 1 HAVING count(*) >= 3)
    SELECT o_orderkey, coalesce(a.v, low) AS o_custkey_count_enc, p.v AS o_orderpriority_count_enc
    FROM base CROSS JOIN m LEFT JOIN a USING (o_custkey) LEFT JOIN p USING (o_orderpriority)""",
)
def e7_count_encode(spark, d):
    rows = orders(spark, d).select(_KEY, *_CATS, "o_orderdate")
    train = rows.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    state = encode.fit_counts(train, _CATS, min_count=3)
    return encode.apply_counts(rows, state, _CATS).select(_KEY, *[f"{c}_count_enc" for c in _CATS])


@query(
    "e7_share_encode",
    """WITH a AS (SELECT o_custkey, count(*) / (SELECT count(*) FROM orders) AS v FROM orders GROUP BY 1)
    SELECT o_orderkey, round(v, 6) AS o_custkey_count_enc FROM orders JOIN a USING (o_custkey)""",
)
def e7_share_encode(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_custkey")
    state = encode.fit_counts(rows, "o_custkey", normalize=True)
    out = encode.apply_counts(rows, state, "o_custkey", handle_unknown="zero")
    return rounded(out.select(_KEY, "o_custkey_count_enc"))


@query(
    "e8_frequency_encode",
    f"""WITH tr AS (SELECT * FROM orders WHERE {_TRAIN}),
    a AS (SELECT o_custkey, row_number() OVER (ORDER BY count(*) DESC, CAST(o_custkey AS VARCHAR)) AS r FROM tr GROUP BY 1),
    p AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS r FROM tr GROUP BY 1)
    SELECT o_orderkey, CAST(coalesce(a.r, (SELECT max(r) + 1 FROM a)) AS DOUBLE) AS o_custkey_freq_enc,
           CAST(coalesce(p.r, (SELECT max(r) + 1 FROM p)) AS DOUBLE) AS o_orderpriority_freq_enc
    FROM orders LEFT JOIN a USING (o_custkey) LEFT JOIN p USING (o_orderpriority)""",
)
def e8_frequency_encode(spark, d):
    rows = table(spark, d, "orders").select(_KEY, *_CATS, "o_orderdate")
    train = rows.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    state = encode.fit_frequency(train, _CATS)
    return encode.apply_frequency(rows, state, _CATS).select(_KEY, *[f"{c}_freq_enc" for c in _CATS])


@query(
    "w7_frequency_rank",
    """SELECT CAST(l_partkey AS VARCHAR) AS category, count(*) AS n,
       row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) AS rank FROM lineitem GROUP BY 1""",
)
def w7_frequency_rank(spark, d):
    return encode.frequency_ranks(table(spark, d, "lineitem"), "l_partkey")


@query(
    "e9_weight_of_evidence",
    f"""WITH {FOLDED},
    g AS (SELECT fold, sum(sum(y)) OVER () - sum(y) AS pp, sum(sum(1 - y)) OVER () - sum(1 - y) AS nn FROM folded GROUP BY fold),
    k AS (SELECT count(DISTINCT o_custkey) AS k FROM folded),
    a AS (SELECT o_custkey, sum(y) AS t, sum(1 - y) AS u FROM folded GROUP BY 1),
    af AS (SELECT o_custkey, fold, sum(y) AS t, sum(1 - y) AS u FROM folded GROUP BY 1, 2)
    SELECT o_orderkey, round(CASE WHEN a.t - af.t + a.u - af.u > 0 THEN
      ln(((a.t - af.t + 0.5) / (pp + 0.5 * k)) / ((a.u - af.u + 0.5) / (nn + 0.5 * k))) ELSE 0 END, 6) AS o_custkey_woe_enc
    FROM folded JOIN g USING (fold) JOIN a USING (o_custkey) JOIN af USING (o_custkey, fold) CROSS JOIN k""",
)
def e9_weight_of_evidence(spark, d):
    out = encode.oof_weight_of_evidence(folded(spark, d), "o_custkey", "y")
    return rounded(out.select(_KEY, "o_custkey_woe_enc"))


@query(
    "e10_fold_average_transform",
    f"""WITH {FOLDED}, tr AS (SELECT * FROM folded WHERE {_TRAIN}), te AS (SELECT * FROM folded WHERE NOT ({_TRAIN})),
    ks AS (SELECT DISTINCT fold AS k FROM tr),
    g AS (SELECT k, avg(y) AS g FROM tr, ks WHERE fold <> k GROUP BY k),
    c AS (SELECT o_custkey, k, (sum(y) + 10 * any_value(g)) / (count(*) + 10) AS v
          FROM tr JOIN g ON tr.fold <> g.k GROUP BY 1, 2),
    m AS (SELECT o_orderkey, avg(coalesce(c.v, g.g)) AS v FROM te CROSS JOIN g
          LEFT JOIN c ON c.o_custkey = te.o_custkey AND c.k = g.k GROUP BY 1)
    SELECT o_orderkey, round(v, 6) AS oof_o_custkey FROM m""",
)
def e10_fold_average_transform(spark, d):
    rows = folded(spark, d)
    train = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    state, prior = encode.fit_fold_average(rows.filter(train), "o_custkey", "y")
    out = encode.apply_fold_average(rows.filter(~train).select(_KEY, "o_custkey"), state, prior, "o_custkey")
    return rounded(out.select(_KEY, "oof_o_custkey"))


@query(
    "f12_seeded_noise",
    """WITH u AS (SELECT o_orderkey, o_totalprice,
      (CAST(CAST('0x' || substr(md5(concat_ws('_', '42_o_totalpriceu', CAST(o_orderkey AS VARCHAR))), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
        / 4503599627370496.0 AS u,
      (CAST(CAST('0x' || substr(md5(concat_ws('_', '42_o_totalpricev', CAST(o_orderkey AS VARCHAR))), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
        / 4503599627370496.0 AS v FROM orders)
    SELECT o_orderkey, round(o_totalprice + 0.5 * sqrt(-2 * ln(u)) * cos(2 * pi() * v), 6) AS o_totalprice FROM u""",
)
def f12_seeded_noise(spark, d):
    rows = table(spark, d, "orders").select(_KEY, "o_totalprice")
    return rounded(encode.with_noise(rows, "o_totalprice", 0.5, _KEY))


@query(
    "a13_value_counts",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 10",
)
def a13_value_counts(spark, d):
    from foldwright.operators.groupby import value_counts

    return value_counts(table(spark, d, "orders"), "o_custkey", min_count=10)


@query(
    "a13_value_shares",
    "SELECT o_orderpriority, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1",
)
def a13_value_shares(spark, d):
    from foldwright.operators.groupby import value_counts

    return rounded(value_counts(table(spark, d, "orders"), "o_orderpriority", normalize=True))
