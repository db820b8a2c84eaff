"""Rolling, expanding and lagged features per key."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from foldwright.functions import names
from foldwright.functions.dates import add_calendar, elapsed_days, micros
from foldwright.functions.names import as_list, require
from foldwright.plans.buckets import as_double
from foldwright.plans.chunks import Running, chunk_windows, global_halo_windows, halo_windows, running_stats
from foldwright.plans.hot import hot_keys, spread
from foldwright.plans.ranks import ordered_index
from foldwright.plans.spans import CLOCK, DAY_US, spanned
from foldwright.session import stage

_STATS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def _known(stats: Sequence[str], allowed: Sequence[str]) -> list[str]:
    skipped = [s for s in stats if s not in allowed]
    if skipped:
        warnings.warn(f"skipping unknown aggregations {skipped}")
    return [s for s in stats if s in allowed]


def _rolling(cols, windows, stats, min_periods, name) -> Callable[[WindowSpec], dict[str, Column]]:
    def build(window: WindowSpec) -> dict[str, Column]:
        made = {}
        for col in cols:
            for width in windows:
                frame = window.rowsBetween(-(width - 1), Window.currentRow)
                enough = F.count(col).over(frame) >= min_periods
                for stat in stats:
                    made[name(col, width, stat)] = F.when(enough, _STATS[stat](F.col(col)).over(frame))
        return made

    return build


def rolling_features(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Sequence[str],
    time: str,
    tie: str,
    windows: Sequence[int] = (7, 14, 30),
    stats: Sequence[str] = ("mean", "std", "sum"),
    min_periods: int = 1,
    name: Callable[[str, int, str], str] | None = None,
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``{v}_rolling{w}_{stat}_by_{keys}`` over the last ``w`` rows, current row included.

    All windows of all columns share one shuffle and one sort. ``tie`` orders
    rows with equal time.
    """
    keys = as_list(keys)
    require(df, [*keys, time, tie])
    cols = [c for c in cols if c in df.columns]
    by = names.group_name(keys)
    name = name or (lambda c, w, s: names.ROLLING.format(col=c, window=w, stat=s, group=by))
    stats = _known(stats, ["mean", "std", "sum", "min", "max"])
    extra = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    build = _rolling(cols, windows, stats, min_periods, name)
    return halo_windows(df, keys, time, tie, build, back=max(windows) - 1, hot_rows=hot_rows, **extra)


def expanding_features(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Sequence[str],
    time: str,
    tie: str,
    stats: Sequence[str] = ("mean", "std", "sum", "count"),
    name: Callable[[str, str], str] | None = None,
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``{v}_expanding_{stat}_by_{keys}`` over all rows up to and including this one."""
    keys = as_list(keys)
    require(df, [*keys, time, tie])
    cols = [c for c in cols if c in df.columns]
    by = names.group_name(keys)
    name = name or (lambda c, s: names.EXPANDING.format(col=c, stat=s, group=by))
    stats = _known(stats, list(_STATS))
    extra = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    return running_stats(df, keys, time, tie, cols, name, stats, hot_rows, **extra)


def lag_features(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Sequence[str],
    time: str,
    tie: str,
    lags: Sequence[int] = (1, 7, 14),
    name: Callable[[str, int], str] | None = None,
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``{v}_lag{n}_by_{keys}``: the value n rows earlier within the key."""
    keys = as_list(keys)
    require(df, [*keys, time, tie])
    cols = [c for c in cols if c in df.columns]
    by = names.group_name(keys)
    name = name or (lambda c, n: names.LAG.format(col=c, lag=n, group=by))

    def build(window: WindowSpec) -> dict[str, Column]:
        return {name(c, n): F.lag(c, n).over(window) for c in cols for n in lags}

    extra = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    return halo_windows(df, keys, time, tie, build, back=max(lags), hot_rows=hot_rows, **extra)


def recency_features(
    df: DataFrame,
    key: str | Sequence[str],
    time: str,
    tie: str,
    col: str,
    windows: Sequence[int] = (7, 30, 90),
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``{v}_{w}d_mean/std/max`` over the last ``w`` rows and ``days_since_last_{v}``."""
    keys = as_list(key)
    roll = _rolling([col], windows, ["mean", "std", "max"], 1, lambda c, w, s: names.DAYS_ROLLING.format(col=c, window=w, stat=s))

    clock = micros(df, time)

    def build(window: WindowSpec) -> dict[str, Column]:
        since = elapsed_days(clock, F.lag(clock, 1).over(window))
        return {**roll(window), names.DAYS_SINCE.format(col=col): since}

    return halo_windows(df, keys, time, tie, build, back=max(windows), hot_rows=hot_rows)


def days_since_previous(
    df: DataFrame, keys: str | Sequence[str], time: str, tie: str, name: str = "days_since_previous",
    hot_rows: int | None = None,
) -> DataFrame:
    """Whole elapsed days (rounded down) since the previous row of the key."""
    clock = micros(df, time)

    def build(window: WindowSpec) -> dict[str, Column]:
        return {name: elapsed_days(clock, F.lag(clock, 1).over(window))}

    return halo_windows(df, as_list(keys), time, tie, build, back=1, hot_rows=hot_rows)


def calendar_rolling(
    df: DataFrame,
    keys: str | Sequence[str],
    cols: Sequence[str],
    time: str,
    days: Sequence[int] = (7, 30),
    stats: Sequence[str] = ("mean", "sum", "count"),
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``{v}_{w}days_{stat}`` over the real time span ``(t - w days, t]``.

    Ordinary keys use a range frame. Hot keys use spans of chunks (``spans``),
    whose work and tasks do not grow with the density of a key or the width of
    a window.
    """
    keys = as_list(keys)
    require(df, [*keys, time, *cols])
    stats = _known(stats, list(_STATS))
    rows = df.withColumn(CLOCK, micros(df, time))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    name = lambda c, w, s: f"{c}_{w}days_{s}"

    def plain(source: DataFrame) -> DataFrame:
        # rows without a key get no value, so they are spread instead of sorted together
        source = source.withColumn("__fw_nk", F.when(known, 0).otherwise(spread(df)))
        by = Window.partitionBy(*keys, "__fw_nk").orderBy(CLOCK)
        frame = {w: by.rangeBetween(-(w * DAY_US - 1), 0) for w in days}
        made = [F.when(known, _STATS[s](F.col(c)).over(frame[w])).alias(name(c, w, s)) for c in cols for w in days for s in stats]
        return source.select(*df.columns, *made)

    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return plain(rows)
    cold = plain(rows.join(hot, keys, "left_anti"))
    heavy = stage(rows.join(hot, keys, "left_semi"), "hot-rows")
    extra = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    return cold.unionByName(spanned(heavy, keys, cols, days, stats, name, **extra))


def series_features(
    df: DataFrame,
    key: str,
    time: str,
    tie: str,
    target: str,
    lags: Sequence[int] = (1, 7, 14, 30),
    windows: Sequence[int] = (7, 14, 30),
    calendar: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Lags, rolling mean/std/min/max, expanding mean and calendar columns of one series."""
    roll = _rolling([target], windows, ["mean", "std", "min", "max"], 1, lambda c, w, s: names.SERIES_ROLLING.format(col=c, stat=s, window=w))

    def build(window: WindowSpec) -> dict[str, Column]:
        moved = {names.SERIES_LAG.format(col=target, lag=n): F.lag(target, n).over(window) for n in lags}
        return {**moved, **roll(window)}

    running = Running([target], ["mean"], lambda c, s: names.SERIES_EXPANDING.format(col=c))
    out = chunk_windows(df, [key], time, tie, build, max(*lags, *windows), 0, running, hot_rows)
    return add_calendar(out, time) if calendar else out


def ahead_rolling_mean(
    df: DataFrame, time: str, tie: str, cols: Sequence[str], width: int = 10, shift: int = 5, **options
) -> DataFrame:
    """Per column the ``width``-row mean ending ``shift`` rows ahead, over global time order.

    Null where the row ``shift`` ahead does not exist. Named ``{v}_ahead``.
    """

    def build(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(-(width - 1 - shift), shift)
        exists = F.lead(F.lit(1), shift).over(window).isNotNull()
        return {f"{c}_ahead": F.when(exists, F.avg(c).over(frame)) for c in cols}

    return global_halo_windows(df, time, tie, build, back=width - 1 - shift, ahead=shift, **options)


def sequence_in_group(
    df: DataFrame, keys: str | Sequence[str], time: str, tie: str, name: str = "position", hot_rows: int | None = None
) -> DataFrame:
    """1-based position by time within the key: the order every operator here sorts by. Null keys form a group.

    Ordinary keys are numbered in one window; rows of hot keys, and those without a key, by ranges.
    """
    keys = as_list(keys)
    hot = hot_keys(df, keys, hot_rows)
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(time, tie)).cast("long")
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    plain, others = df.filter(known), df.filter(~known)
    if hot is not None:
        plain, others = plain.join(hot, keys, "left_anti"), others.unionByName(plain.join(hot, keys, "left_semi"))
    others = stage(others, "hot-rows")
    plain = plain.withColumn(name, at)
    if others.isEmpty():
        return plain
    ranged = ordered_index(others, time, tie, keys, name="__fw_at")
    return plain.unionByName(ranged.withColumn(name, F.col("__fw_at") + 1).drop("__fw_at"))
