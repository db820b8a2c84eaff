"""Quality, drift and sessions per event-time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scalars import bin_number
from foldwright.operators import monitor


def windowed_report(
    stream: DataFrame,
    time: str,
    latency: str,
    error: str,
    window: str = "1 day",
    slide: str | None = None,
    delay: str = "1 hour",
    accuracy: int = 10_000,
) -> DataFrame:
    """Count, latency percentiles and errors per tumbling or sliding window.

    Percentiles are sketches: state per window stays small however many rows it has.
    """
    span = F.window(time, window, slide) if slide else F.window(time, window)
    grouped = stream.withWatermark(time, delay).groupBy(span.alias("w")).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.percentile_approx(latency, [0.5, 0.95, 0.99], accuracy).alias("q"),
        F.avg(latency).alias("latency_mean"),
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(F.col(error) * F.col(error))).alias("rmse"),
    )
    return grouped.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "total_predictions",
        *[F.element_at("q", i + 1).alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))],
        "latency_mean",
        "mae",
        "rmse",
    )


def windowed_bins(
    stream: DataFrame, time: str, edges: dict[str, Sequence[float]], window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """``(window_start, feature, bin, n)``: the reference is only a few numbers, inlined."""
    cells = [F.struct(F.lit(c).alias("feature"), bin_number(c, e).alias("bin")) for c, e in edges.items()]
    long = stream.withWatermark(time, delay).select(time, F.explode(F.array(*cells)).alias("e"))
    counts = long.filter(F.col("e.bin").isNotNull()).groupBy(
        F.window(time, window).alias("w"), F.col("e.feature").alias("feature"), F.col("e.bin").alias("bin")
    )
    return counts.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "feature", "bin", "n")


def windowed_psi(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """PSI per closed window and feature; all bins of a window close in one batch."""
    by = ["window_start"]
    return monitor.psi(reference, monitor.bin_shares(counts, by), by=by)


def sessions(
    stream: DataFrame, key: str, time: str, value: str, gap: str = "30 minutes", delay: str = "1 hour"
) -> DataFrame:
    """Activity summary per key, split where nothing happened for ``gap``."""
    grouped = stream.withWatermark(time, delay).groupBy(key, F.session_window(time, gap).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total"), F.max(value).alias("largest")
    )
    return grouped.select(
        key,
        F.col("w.start").alias("session_start"),
        F.col("w.end").alias("session_end"),
        "n_events",
        "total",
        "largest",
    )
