"""Streams over several files: late rows, state across batches, closed windows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from foldwright.operators import encode
from foldwright.streaming import encode as stream_encode
from foldwright.streaming import monitor as stream_monitor
from foldwright.streaming.previous import previous_stream
from foldwright.streaming.runner import event_time, parquet_stream, run_available, run_closed

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, user string, ts timestamp_ntz, value double"


def at(hours: float) -> dt.datetime:
    return START + dt.timedelta(hours=hours)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Four files, read one per micro-batch; row 7 is late, row 9 closes the windows.

    Rows are late by the watermark of the batch before last, hence the third file.
    """
    path = str(tmp_path_factory.mktemp("stream"))
    files = [
        [(1, "a", at(0.1), 1.0), (2, "a", at(0.2), 2.0), (3, "b", at(1.5), 3.0)],
        [(4, "a", at(26), 4.0), (5, "b", at(26.5), 5.0), (6, "a", at(26.2), 6.0)],
        [(10, "b", at(27), 10.0)],
        [(7, "a", at(0.3), 7.0), (8, "b", at(30), 8.0), (9, "z", at(200), 9.0)],
    ]
    for lines in files:
        spark.createDataFrame(lines, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return event_time(parquet_stream(spark, folder, schema, files_per_trigger=1), "ts")


def test_windowed_report_drops_late_rows(spark, folder):
    rows = stream(spark, folder).withColumn("error", F.lit(1.0))
    out = run_available(stream_monitor.windowed_report(rows, "ts", "value", "error", "1 day", delay="1 hour"), "t-r1")
    got = {r["window_start"]: (r["total_predictions"], r["p50_ms"]) for r in out.collect()}
    # day 1 closed before the late row came; the last day stays open
    assert got == {at(0): (3, 2.0), at(24): (5, 6.0)}


def test_sessions(spark, folder):
    out = run_available(stream_monitor.sessions(stream(spark, folder), "user", "ts", "value", "1 hour"), "t-r5")
    got = sorted((r["user"], r["n_events"], r["total"]) for r in out.collect())
    assert got == [("a", 2, 3.0), ("a", 2, 10.0), ("b", 1, 3.0), ("b", 1, 8.0), ("b", 2, 15.0)]


def test_previous_value_across_batches(spark, folder):
    out = run_available(previous_stream(stream(spark, folder), "user", "ts", "id", "value"), "t-r4")
    got = {r["id"]: (r["previous"], r["days_since"]) for r in out.collect()}
    assert got[1] == (None, None)
    assert got[2] == (1.0, 0)
    assert got[4] == (2.0, 1)
    assert got[6] == (4.0, 0)
    assert got[5] == (3.0, 1)
    assert got[10] == (5.0, 0)
    assert got[8] == (10.0, 0)


@pytest.mark.parametrize("n_files", [1, 4, 23])
def test_previous_value_does_not_depend_on_the_split(spark, tmp_path, n_files):
    """Rows come up to two hours out of order, within the delay; equal times fall into different files."""
    rng = random.Random(4)
    hours = [rng.choice([i / 3, float(i // 3)]) for i in range(300)]
    rows = [(i, rng.choice("abc") if i % 40 else None, at(h), None if i % 9 == 0 else float(i)) for i, h in enumerate(hours)]
    rows.sort(key=lambda r: (r[2] - START).total_seconds() / 3600 + 2 * rng.random())
    rows.append((999, "z", at(500), 0.0))
    size = -(-len(rows) // n_files)
    for n in range(0, len(rows), size):
        spark.createDataFrame(rows[n : n + size], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
    before = {c: v for c, v in spark.conf.getAll.items()}
    out = run_available(previous_stream(stream(spark, str(tmp_path)), "user", "ts", "id", "value", delay="3 hours"), "t-r4")
    assert {c: v for c, v in spark.conf.getAll.items()} == before
    last, want = {}, {}
    for i, user, ts, value in sorted(rows[:-1], key=lambda r: (r[2], r[0])):
        seen = last.get(user)
        want[i] = (None, None) if seen is None else (seen[1], (ts - seen[0]).days)
        last[user] = (ts, value)
    got = {r["id"]: (r["previous"], r["days_since"]) for r in out.collect()}
    assert got == want


def test_a_closed_stream_emits_every_row(spark, tmp_path):
    """Rows within the delay of the newest one come too, a key's only row, and rows without a time last."""
    files = [
        [(1, "a", at(0), 1.0), (2, "b", at(49.5), 2.0), (8, "a", None, 8.0), (3, None, at(50), 3.0)],
        [(4, "a", at(49.9), 4.0), (5, "c", at(50), 5.0), (7, "a", None, 7.0), (6, "a", at(49.8), 6.0)],
    ]
    for lines in files:
        spark.createDataFrame(lines, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
    rows = stream(spark, str(tmp_path))
    out = run_closed(rows, "ts", lambda r: previous_stream(r, "user", "ts", "id", "value"), "t-r4-closed")
    got = {r["id"]: (r["user"], r["previous"], r["days_since"]) for r in out.collect()}
    assert got == {
        1: ("a", None, None), 6: ("a", 1.0, 2), 4: ("a", 6.0, 0), 7: ("a", 4.0, None), 8: ("a", 7.0, None),
        2: ("b", None, None), 3: (None, None, None), 5: ("c", None, None),
    }


def test_stream_encoding_equals_batch(spark, folder):
    base = spark.read.schema(SCHEMA).parquet(folder).withColumn("y", (F.col("value") > 4).cast("int"))
    state = encode.fit_target(base.filter("user <> 'z'"), "user", "y")
    want = {r["id"]: r["user_target_enc"] for r in encode.apply_target(base, state, "user").collect()}
    rows = stream_encode.encode_stream(stream(spark, folder), state, ["user"])
    got = {r["id"]: r["user_target_enc"] for r in run_available(rows, "t-r3").collect()}
    assert got == pytest.approx(want)
