"""Streams over the events table, compared with the batch answer for closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwright.catalog.registry import query, rounded
from foldwright.operators import encode, monitor
from foldwright.sources.tables import table
from foldwright.streaming import encode as stream_encode
from foldwright.streaming import monitor as stream_monitor
from foldwright.streaming.previous import previous_stream
from foldwright.streaming.runner import event_time, parquet_stream, run_available, run_batches, run_closed


def _events(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    rows = event_time(parquet_stream(spark, d, schema, "events.parquet"), "ts")
    error = F.abs(F.col("value") / 500 - (F.col("event_type") == "error").cast("double"))
    return rows.withColumn("error", error)


# append mode emits a window once the watermark (newest time minus the delay) has passed its end
_MARK = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)"


def _report_sql(start: str, length: str) -> str:
    return f"""WITH e AS (SELECT {start} AS s, value AS l, abs(value / 500 - CAST(event_type = 'error' AS DOUBLE)) AS e FROM events)
    SELECT epoch(s)::BIGINT AS window_start, count(*) AS total_predictions, round(quantile_disc(l, 0.5), 6) AS p50_ms, round(quantile_disc(l, 0.95), 6) AS p95_ms,
           round(quantile_disc(l, 0.99), 6) AS p99_ms, round(avg(l), 6) AS latency_mean,
           round(avg(e), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse FROM e
    GROUP BY s HAVING s + INTERVAL {length} <= {_MARK}"""


def _flat(df):
    return rounded(
        df.select(
            F.unix_timestamp("window_start").alias("window_start"), "total_predictions", "p50_ms", "p95_ms", "p99_ms", "latency_mean", "mae", "rmse"
        )
    )


@query("r1_tumbling_report", _report_sql("time_bucket(INTERVAL 6 HOUR, ts)", "6 HOUR"))
def r1_tumbling_report(spark, d):
    out = stream_monitor.windowed_report(_events(spark, d), "ts", "value", "error", "6 hours")
    return _flat(run_available(out, "r1"))


@query(
    "r1_sliding_report",
    """WITH e AS (SELECT unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS s, value AS l,
       abs(value / 500 - CAST(event_type = 'error' AS DOUBLE)) AS e FROM events)
    SELECT epoch(s)::BIGINT AS window_start, count(*) AS total_predictions, round(quantile_disc(l, 0.5), 6) AS p50_ms, round(quantile_disc(l, 0.95), 6) AS p95_ms,
           round(quantile_disc(l, 0.99), 6) AS p99_ms, round(avg(l), 6) AS latency_mean,
           round(avg(e), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse FROM e
    GROUP BY s HAVING s + INTERVAL 24 HOUR <= """ + _MARK,
)
def r1_sliding_report(spark, d):
    out = stream_monitor.windowed_report(_events(spark, d), "ts", "value", "error", "24 hours", "12 hours")
    return _flat(run_available(out, "r1s"))


_EDGES = "(SELECT list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM events WHERE event_type = 'view')"


@query(
    "r2_windowed_psi",
    f"""WITH t AS (SELECT date_trunc('day', ts) AS s, (SELECT count(*) FROM unnest(e) u(x) WHERE x < value) AS b, event_type FROM events, {_EDGES}),
    r AS (SELECT b, count(*) / sum(count(*)) OVER () AS r FROM t WHERE event_type = 'view' GROUP BY 1),
    c AS (SELECT s, b, count(*) / sum(count(*)) OVER (PARTITION BY s) AS c FROM t GROUP BY 1, 2),
    g AS (SELECT s, b, r FROM (SELECT DISTINCT s FROM c), r),
    j AS (SELECT coalesce(g.s, c.s) AS s, greatest(coalesce(r, 0), 0.001) AS r, greatest(coalesce(c, 0), 0.001) AS c
          FROM g FULL JOIN c ON g.s = c.s AND g.b = c.b)
    SELECT epoch(s)::BIGINT AS window_start, 'value' AS feature, round(sum((c - r) * ln(c / r)), 6) AS psi,
           sum((c - r) * ln(c / r)) > 0.25 AS drift_detected FROM j GROUP BY s HAVING s + INTERVAL 1 DAY <= {_MARK}""",
)
def r2_windowed_psi(spark, d):
    base = table(spark, d, "events").filter("event_type = 'view'")
    edges = monitor.bin_edges(base, ["value"])
    reference = monitor.bin_shares(monitor.bin_counts(base, edges))
    counts = stream_monitor.windowed_bins(_events(spark, d), "ts", edges)
    empty = spark.createDataFrame([], "window_start timestamp, feature string, psi double, drift_detected boolean")
    out = run_batches(counts, "r2", lambda batch: stream_monitor.windowed_psi(batch, reference), empty.schema)
    return rounded(out.withColumn("window_start", F.unix_timestamp("window_start")))


@query(
    "r3_stream_target_encode",
    """WITH t AS (SELECT *, CAST(event_type = 'error' AS INTEGER) AS y FROM events), g AS (SELECT avg(y) AS g FROM t)
    SELECT event_id, round((sum(y) OVER (PARTITION BY user_id) + 10 * g) / (count(*) OVER (PARTITION BY user_id) + 10), 6)
           AS user_id_target_enc FROM t, g""",
)
def r3_stream_target_encode(spark, d):
    known = table(spark, d, "events").withColumn("y", (F.col("event_type") == "error").cast("int"))
    state = encode.fit_target(known, "user_id", "y")
    out = stream_encode.encode_stream(_events(spark, d).select("event_id", "user_id"), state, ["user_id"])
    return rounded(run_available(out.select("event_id", "user_id_target_enc"), "r3"))


@query(
    "r4_previous_value",
    """SELECT user_id, event_id AS id, lag(value) OVER w AS previous,
       CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 86400000000) AS BIGINT) AS days_since
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def r4_previous_value(spark, d):
    return run_closed(_events(spark, d), "ts", lambda rows: previous_stream(rows, "user_id", "ts", "event_id", "value"), "r4")


@query(
    "r5_sessions",
    f"""WITH m AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 6 * 3600000000 THEN 0 ELSE 1 END AS n
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM m)
    SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts)) + 6 * 3600000000 AS session_end, count(*) AS n_events,
           round(sum(value), 6) AS total, max(value) AS largest FROM s GROUP BY user_id, k
    HAVING max(ts) + INTERVAL 6 HOUR <= {_MARK}""",
)
def r5_sessions(spark, d):
    out = run_available(stream_monitor.sessions(_events(spark, d), "user_id", "ts", "value", "6 hours"), "r5")
    return rounded(out.withColumns({c: F.unix_micros(c) for c in ("session_start", "session_end")}))


@query(
    "s7_stream_log",
    """SELECT event_id, value / 500 AS prediction, value AS latency_ms FROM events""",
)
def s7_stream_log(spark, d):
    from foldwright.session import scratch_path
    from foldwright.sources.sinks import stream_log

    log = monitor.log_rows(
        _events(spark, d).withColumn("p", F.col("value") / 500), "p", ["value"], "m", "1", "ts",
        latency_ms="value", keep=["event_id"],
    )
    path = scratch_path(spark, "log")
    stream_log(log.drop("feature_stats"), path, scratch_path(spark, "log-checkpoint")).awaitTermination()
    return spark.read.parquet(path).select("event_id", "prediction", "latency_ms")
