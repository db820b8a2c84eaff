"""Rolling, expanding, lagged and calendar features; as-of and merged lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import query, rounded
from foldwright.functions import dates
from foldwright.operators import lookup, windows
from foldwright.sources.tables import table


def _events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "ts", "value")


_W = "PARTITION BY user_id ORDER BY ts, event_id"
_AGG = {"mean": "avg", "std": "stddev_samp", "sum": "sum", "min": "min", "max": "max", "count": "count"}


def _frame(stat: str, width: int | None, least: int = 1) -> str:
    start = "UNBOUNDED" if width is None else str(width - 1)
    over = f"OVER ({_W} ROWS BETWEEN {start} PRECEDING AND CURRENT ROW)"
    made = f"{_AGG[stat]}(value) {over}"
    # eight digits: a mean of 32 cent values ends exactly on the tie of six
    made = made if stat == "count" else f"round({made}, 8)"
    return made if least <= 1 else f"CASE WHEN count(value) {over} >= {least} THEN {made} END"


_W1 = "SELECT event_id, " + ", ".join(
    f"{_frame(s, w)} AS value_rolling{w}_{s}_by_user_id" for w in (7, 14, 30) for s in ("mean", "std", "sum")
) + " FROM events"


@query("w1_rolling", _W1)
def w1_rolling(spark, d):
    out = windows.rolling_features(_events(spark, d), "user_id", ["value"], "ts", "event_id")
    return rounded(out.drop("user_id", "ts", "value"), 8)


@query("w1_rolling_hot_split", _W1)
def w1_rolling_hot_split(spark, d):
    """Users above 50 events are cut into chunks of 40 rows with a halo."""
    out = windows.rolling_features(
        _events(spark, d), "user_id", ["value"], "ts", "event_id", hot_rows=50, chunk_rows=40
    )
    return rounded(out.drop("user_id", "ts", "value"), 8)


@query(
    "w1_rolling_min_periods",
    "SELECT event_id, " + ", ".join(
        f"{_frame(s, 5, 3)} AS value_rolling5_{s}_by_user_id" for s in ("mean", "min", "max")
    ) + " FROM events",
)
def w1_rolling_min_periods(spark, d):
    out = windows.rolling_features(
        _events(spark, d), "user_id", ["value"], "ts", "event_id", [5], ["mean", "min", "max"], min_periods=3
    )
    return rounded(out.drop("user_id", "ts", "value"), 8)


_W2_STATS = ("mean", "std", "sum", "count", "min", "max")
_W2 = "SELECT event_id, " + ", ".join(
    f"{_frame(s, None)} AS value_expanding_{s}_by_user_id" for s in _W2_STATS
) + " FROM events"


@query("w2_expanding", _W2)
def w2_expanding(spark, d):
    out = windows.expanding_features(_events(spark, d), "user_id", ["value"], "ts", "event_id", _W2_STATS)
    return rounded(out.drop("user_id", "ts", "value"), 8)


@query("w2_expanding_hot_split", _W2)
def w2_expanding_hot_split(spark, d):
    """Users above 50 events: running totals inside chunks of 16 plus a carry."""
    out = windows.expanding_features(
        _events(spark, d), "user_id", ["value"], "ts", "event_id", _W2_STATS, hot_rows=50, chunk_rows=16
    )
    return rounded(out.drop("user_id", "ts", "value"), 8)


_W3 = "SELECT event_id, " + ", ".join(
    f"lag(value, {n}) OVER ({_W}) AS value_lag{n}_by_user_id" for n in (1, 7, 14)
) + " FROM events"


@query("w3_lag", _W3)
def w3_lag(spark, d):
    return windows.lag_features(_events(spark, d), "user_id", ["value"], "ts", "event_id").drop("user_id", "ts", "value")


@query("w3_lag_hot_split", _W3)
def w3_lag_hot_split(spark, d):
    out = windows.lag_features(
        _events(spark, d), "user_id", ["value"], "ts", "event_id", hot_rows=50, chunk_rows=20
    )
    return out.drop("user_id", "ts", "value")


_GAP = f"CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER ({_W}))) / 86400000000) AS BIGINT)"


@query(
    "w4_recency_rolling",
    "SELECT event_id, " + ", ".join(
        f"{_frame(s, w)} AS value_{w}d_{s}" for w in (7, 30, 90) for s in ("mean", "std", "max")
    ) + f", {_GAP} AS days_since_last_value FROM events",
)
def w4_recency_rolling(spark, d):
    out = windows.recency_features(_events(spark, d), "user_id", "ts", "event_id", "value")
    return rounded(out.drop("user_id", "ts", "value"), 8)


_SPAN = """OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {0} PRECEDING AND CURRENT ROW)"""
_W4 = "SELECT event_id, " + ", ".join(
    f"round(avg(value) {_SPAN.format(w * 86400000000 - 1)}, 6) AS value_{w}days_mean, "
    f"round(sum(value) {_SPAN.format(w * 86400000000 - 1)}, 6) AS value_{w}days_sum, "
    f"count(value) {_SPAN.format(w * 86400000000 - 1)} AS value_{w}days_count" for w in (2, 7)
) + " FROM events"


@query("w4_calendar_rolling", _W4)
def w4_calendar_rolling(spark, d):
    out = windows.calendar_rolling(_events(spark, d), "user_id", ["value"], "ts", (2, 7))
    return rounded(out.drop("user_id", "ts", "value"))


@query("w4_calendar_rolling_hot_split", _W4)
def w4_calendar_rolling_hot_split(spark, d):
    out = windows.calendar_rolling(_events(spark, d), "user_id", ["value"], "ts", (2, 7), hot_rows=60)
    return rounded(out.drop("user_id", "ts", "value"))


@query("w5_days_since_previous", f"SELECT event_id, {_GAP} AS days_since_previous FROM events")
def w5_days_since_previous(spark, d):
    out = windows.days_since_previous(_events(spark, d), "user_id", "ts", "event_id")
    return out.select("event_id", "days_since_previous")


_CALENDAR = """CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month, CAST(day({t}) AS INTEGER) AS day,
  CAST(isodow({t}) - 1 AS INTEGER) AS dayofweek, CAST(dayofyear({t}) AS INTEGER) AS dayofyear,
  CAST(weekofyear({t}) AS INTEGER) AS weekofyear, CAST(quarter({t}) AS INTEGER) AS quarter,
  round(sin(2 * pi() * month({t}) / 12), 8) + 0 AS month_sin, round(cos(2 * pi() * month({t}) / 12), 8) + 0 AS month_cos,
  round(sin(2 * pi() * (isodow({t}) - 1) / 7), 8) + 0 AS dayofweek_sin,
  round(cos(2 * pi() * (isodow({t}) - 1) / 7), 8) + 0 AS dayofweek_cos,
  CAST(isodow({t}) >= 6 AS INTEGER) AS is_weekend, CAST(day({t}) = 1 AS INTEGER) AS is_month_start,
  CAST(CAST({t} AS DATE) = last_day({t}) AS INTEGER) AS is_month_end"""


@query(
    "w6_series_features",
    "SELECT event_id, " + ", ".join(f"lag(value, {n}) OVER ({_W}) AS value_lag_{n}" for n in (1, 7, 14, 30)) + ", "
    + ", ".join(f"{_frame(s, w)} AS value_rolling_{s}_{w}" for w in (7, 14, 30) for s in ("mean", "std", "min", "max"))
    + f", {_frame('mean', None)} AS value_expanding_mean, {_CALENDAR.format(t='ts')} FROM events",
)
def w6_series_features(spark, d):
    out = windows.series_features(_events(spark, d), "user_id", "ts", "event_id", "value")
    return rounded(out.drop("user_id", "ts", "value"), 8)


@query(
    "t1_sequence_in_group",
    f"SELECT event_id, row_number() OVER ({_W}) AS position FROM events",
)
def t1_sequence_in_group(spark, d):
    return windows.sequence_in_group(_events(spark, d), "user_id", "ts", "event_id").select("event_id", "position")


@query("f1_calendar_parts", f"SELECT o_orderkey, {_CALENDAR.format(t='o_orderdate')} FROM orders")
def f1_calendar_parts(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return rounded(dates.add_calendar(rows, "o_orderdate").drop("o_orderdate"), 8)


@query("f2_day_of_week", "SELECT l_shipdate::VARCHAR AS day, CAST(isodow(l_shipdate) - 1 AS INTEGER) AS dow, count(*) AS n FROM lineitem GROUP BY 1, 2")
def f2_day_of_week(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("day"), dates.day_of_week(F.col("l_shipdate")).alias("dow")
    )
    return rows.groupBy("day", "dow").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f3_cyclic",
    """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0 AS hour_cos
       FROM events""",
)
def f3_cyclic(spark, d):
    sin, cos = dates.cyclic(F.hour("ts"), 24)
    return rounded(table(spark, d, "events").select("event_id", sin.alias("hour_sin"), cos.alias("hour_cos")))


@query(
    "f4_month_edges",
    """SELECT CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(day(ts) = 1 AS INTEGER) AS is_month_start,
       CAST(CAST(ts AS DATE) = last_day(ts) AS INTEGER) AS is_month_end, count(*) AS n, round(avg(value), 6) AS value
       FROM events GROUP BY 1, 2, 3""",
)
def f4_month_edges(spark, d):
    flags = ["is_weekend", "is_month_start", "is_month_end"]
    rows = dates.add_calendar(table(spark, d, "events"), "ts")
    return rounded(rows.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("value")))


_AHEAD = "avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING)"
_W9 = f"""SELECT event_id, CASE WHEN lead(1, 5) OVER (ORDER BY ts, event_id) IS NOT NULL THEN round({_AHEAD}, 6) END AS value_ahead
          FROM events"""


@query("w9_ahead_rolling_mean", _W9)
def w9_ahead_rolling_mean(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts", "value")
    out = windows.ahead_rolling_mean(rows, "ts", "event_id", ["value"], chunk_rows=500)
    return rounded(out.select("event_id", "value_ahead"))


@query(
    "j4_overlap",
    """WITH a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'),
       b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
       x AS (SELECT *, count(*) AS n FROM a GROUP BY ALL), y AS (SELECT *, count(*) AS m FROM b GROUP BY ALL)
       SELECT CAST(sum(n * m) AS BIGINT) AS n_pairs, count(*) AS n_distinct, CAST(sum(n) AS BIGINT) AS n_train_rows,
              CAST(sum(m) AS BIGINT) AS n_test_rows FROM x JOIN y USING (o_custkey, o_orderpriority)""",
)
def j4_overlap(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    return lookup.overlap(rows.filter(early), rows.filter(~early), exclude=["o_orderdate"])


@query(
    "j5_membership",
    """SELECT o_orderkey, CAST(o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS INTEGER) AS member
       FROM orders""",
)
def j5_membership(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    building = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    inside = lookup.in_groups(rows, building, "c_custkey").withColumn("member", F.lit(1))
    outside = lookup.not_in_groups(rows, building, "c_custkey").withColumn("member", F.lit(0))
    return inside.unionByName(outside).select("o_orderkey", "member")


@query(
    "j7_merged_vector",
    """WITH offl AS (SELECT o_custkey, round(avg(o_totalprice), 6) AS spend, count(*) AS n_orders FROM orders GROUP BY 1),
       onl AS (SELECT o_custkey, max(o_totalprice) AS spend, max(o_totalprice) AS top FROM orders
               WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
       SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END, offl.spend, onl.spend) AS spend,
              n_orders, top FROM customer LEFT JOIN offl ON offl.o_custkey = c_custkey LEFT JOIN onl ON onl.o_custkey = c_custkey""",
)
def j7_merged_vector(spark, d):
    raw = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal")).alias("spend")
    )
    bought = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    offline = bought.groupBy("c_custkey").agg(
        F.round(F.avg("o_totalprice"), 6).alias("spend"), F.count(F.lit(1)).alias("n_orders")
    )
    recent = bought.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    online = recent.groupBy("c_custkey").agg(F.max("o_totalprice").alias("spend"), F.max("o_totalprice").alias("top"))
    return lookup.merge_vectors(raw, offline, online, "c_custkey", ["spend", "n_orders", "top"])


_J8 = """WITH f AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
  v AS (SELECT user_id, ts, value AS seen_value, event_id AS seen_id FROM events WHERE event_type = 'view')
  SELECT f.event_id, v.seen_value, v.seen_id FROM f ASOF LEFT JOIN v ON f.user_id = v.user_id AND f.ts >= v.ts"""


def _as_of(spark, d, **options):
    events = table(spark, d, "events")
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = events.filter("event_type = 'view'").select(
        "user_id", "ts", F.col("value").alias("seen_value"), F.col("event_id").alias("seen_id")
    )
    out = lookup.as_of(bought, seen, "user_id", "ts", ["seen_value", "seen_id"], "event_id", "seen_id", **options)
    return out.select("event_id", "seen_value", "seen_id")


@query("j8_as_of", _J8)
def j8_as_of(spark, d):
    return _as_of(spark, d)


@query("j8_as_of_hot_split", _J8)
def j8_as_of_hot_split(spark, d):
    return _as_of(spark, d, hot_rows=20, chunk_rows=8)
