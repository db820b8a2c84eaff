"""Prediction logs, drift and quality reports in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scalars import bin_number
from foldwright.plans.quantiles import table_quantiles

# Default alert limits.
ALERTS = {"accuracy_drop": 0.05, "latency_p99": 100.0, "error_rate": 0.01, "data_drift": 0.1}
PSI_DRIFT = 0.25
MISSING_SHARE = 0.001


def log_rows(
    df: DataFrame,
    prediction: str,
    features: Sequence[str],
    model_name: str,
    model_version: str,
    time: str,
    actual: str | None = None,
    latency_ms: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One log row per prediction with error and the spread of its features."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    n = F.lit(float(len(features)))
    mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
    var = F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / n
    real = F.col(actual).cast("double") if actual else F.lit(None).cast("double")
    return df.select(
        *keep,
        F.col(time).alias("timestamp"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.col(prediction).cast("double").alias("prediction"),
        (F.col(latency_ms).cast("double") if latency_ms else F.lit(None).cast("double")).alias("latency_ms"),
        real.alias("actual"),
        F.abs(F.col(prediction).cast("double") - real).alias("error"),
        F.struct(
            mean.alias("mean"), F.sqrt(var).alias("std"), F.array_min(x).alias("min"), F.array_max(x).alias("max")
        ).alias("feature_stats"),
    )


def bin_edges(reference: DataFrame, cols: Sequence[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Inner quantile edges of the reference; a few numbers per feature."""
    found = table_quantiles(reference, cols, [i / n_bins for i in range(1, n_bins)])
    return {c: sorted({e for e in found[c] if e is not None}) for c in cols}


def bin_counts(df: DataFrame, edges: dict[str, Sequence[float]], by: Sequence[str] = ()) -> DataFrame:
    """``(by, feature, bin, n)`` for every feature in one aggregate."""
    cells = [F.struct(F.lit(c).alias("feature"), bin_number(c, e).alias("bin")) for c, e in edges.items()]
    long = df.select(*by, F.explode(F.array(*cells)).alias("e")).filter(F.col("e.bin").isNotNull())
    return long.groupBy(*by, "e.feature", "e.bin").agg(F.count(F.lit(1)).alias("n"))


def bin_shares(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts to shares within each feature (and group)."""
    keys = [*by, "feature"]
    whole = counts.groupBy(*keys).agg(F.sum("n").alias("all_n"))
    return counts.join(whole, keys).select(*keys, "bin", (F.col("n") / F.col("all_n")).alias("share"))


def psi(
    reference: DataFrame, current: DataFrame, floor: float = MISSING_SHARE, strict: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Population stability index per feature from two ``(feature, bin, share)`` tables.

    Both shares are floored, so a bin on one side only gives a finite term.
    ``strict`` sums over the reference bins alone and floors only missing
    current bins. ``by`` compares each group of the current table.
    """

    def packed(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        # one entry per bin, and bins are few
        entries = F.collect_list(F.struct("bin", "share"))
        return table.groupBy(*keys).agg(F.map_from_entries(entries).alias(name))

    one, other = packed(reference, ["feature"], "r"), packed(current, [*by, "feature"], "c")
    both = other.join(one, "feature", "inner") if by else one.join(other, "feature", "left" if strict else "full")
    nothing = F.expr("cast(map() as map<int, double>)")
    both = both.withColumns({"r": F.coalesce("r", nothing), "c": F.coalesce("c", nothing)})
    bins = F.map_keys("r") if strict else F.array_union(F.map_keys("r"), F.map_keys("c"))

    def term(b: Column) -> Column:
        r, c = F.try_element_at("r", b), F.try_element_at("c", b)
        if strict:
            c = F.coalesce(c, F.lit(floor))
        else:
            r, c = (F.greatest(F.coalesce(v, F.lit(0.0)), F.lit(floor)) for v in (r, c))
        return (c - r) * F.ln(F.try_divide(c, r))

    value = F.aggregate(F.transform(bins, term), F.lit(0.0), lambda acc, x: acc + x)
    return both.select(*by, "feature", value.alias("psi")).withColumn("drift_detected", F.col("psi") > PSI_DRIFT)


def drift(
    reference: DataFrame, current: DataFrame, cols: Sequence[str], n_bins: int = 10, strict: bool = False,
) -> DataFrame:
    """PSI of raw columns: quantile bins of the reference, then shares on both sides."""
    edges = bin_edges(reference, cols, n_bins)
    return psi(bin_shares(bin_counts(reference, edges)), bin_shares(bin_counts(current, edges)), strict=strict)


def quality_report(
    log: DataFrame,
    time: str = "timestamp",
    latency: str = "latency_ms",
    error: str = "error",
    cutoff: Column | None = None,
) -> DataFrame:
    """Count, latency percentiles/mean/std, MAE and RMSE of rows after ``cutoff`` (exclusive)."""
    rows = log if cutoff is None else log.filter(F.col(time) > cutoff)
    one = rows.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.avg(latency).alias("latency_mean"),
        F.stddev_pop(latency).alias("latency_std"),
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(F.col(error) * F.col(error))).alias("rmse"),
    )
    found = table_quantiles(rows, [latency], [0.5, 0.95, 0.99])[latency]
    named = zip(("p50_ms", "p95_ms", "p99_ms"), found)
    return one.withColumns({n: F.lit(v).cast("double") for n, v in named})


def alerts(
    report: DataFrame,
    limits: dict[str, float] | None = None,
    accuracy: Column | None = None,
    baseline_accuracy: float | None = None,
    error_rate: Column | None = None,
    data_drift: Column | None = None,
) -> DataFrame:
    """Add ``alerts`` (names of the limits exceeded) and ``healthy``."""
    limits = {**ALERTS, **(limits or {})}
    raised = [F.when(F.col("p99_ms") > limits["latency_p99"], "latency")]
    if accuracy is not None and baseline_accuracy is not None:
        raised.append(F.when(F.lit(baseline_accuracy) - accuracy > limits["accuracy_drop"], "accuracy"))
    if error_rate is not None:
        raised.append(F.when(error_rate > limits["error_rate"], "errors"))
    if data_drift is not None:
        raised.append(F.when(data_drift > limits["data_drift"], "drift"))
    names = F.filter(F.array(*raised), lambda a: a.isNotNull())
    return report.withColumn("alerts", F.array_join(names, ",")).withColumn("healthy", F.size(names) == 0)
