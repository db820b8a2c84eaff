"""Ordered windows per key that survive a hot key.

Ordinary keys use one window. Rows of hot keys are written once, get their exact
position within the key and are dealt into chunks of consecutive positions. A
chunk sees a halo of neighbouring rows, for frames of fixed length, and a carry
from the chunks before, for running frames; both kinds share one shuffle. The
table itself is read for its keys, for the rows of ordinary keys and for those
of hot keys.

Running sums use one arithmetic on both paths: deviations from the key's mean,
which keeps squares well conditioned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from foldwright.plans.hot import SPREAD, hot_keys, spread
from foldwright.plans.ranks import ordered_index
from foldwright.session import stage

CHUNK_ROWS = 500_000
_INDEX, _CHUNK, _HOME, _NULLS = "__fw_i", "__fw_c", "__fw_home", "__fw_nk"

Build = Callable[[WindowSpec], dict[str, Column]]


def _has_key(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def _plain(df: DataFrame, keys: Sequence[str], order: str, tie: str, build: Build, running: Running | None = None) -> DataFrame:
    # rows without a key get no value, so they are spread instead of sorted together
    rows = df.withColumn(_NULLS, F.when(_has_key(keys), 0).otherwise(spread(df, SPREAD)))
    window = Window.partitionBy(*keys, _NULLS).orderBy(order, tie)
    made = build(window)
    spare = [_NULLS]
    if running is not None:
        # the same order serves the mean of the whole key
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.select("*", *[F.avg(c).over(whole).alias(_mu(c)) for c in running.cols])
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inside = {c: {p: e.over(frame) for p, e in running.parts(c).items()} for c in running.cols}
        made |= running.values(inside)
        spare += [_mu(c) for c in running.cols]
    return rows.select("*", *[F.when(_has_key(keys), c).alias(n) for n, c in made.items()]).drop(*spare)


def _split(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and those of hot keys written once, as every later step reads them again."""
    return df.join(hot, list(keys), "left_anti"), stage(df.join(hot, list(keys), "left_semi"), "hot-rows")


def _mu(col: str) -> str:
    return f"__fw_mu_{col}"


@dataclass(frozen=True)
class Running:
    """Running count, sum, mean, std, min and max of some columns, current row included."""

    cols: Sequence[str]
    stats: Sequence[str]
    name: Callable[[str, str], str]

    @staticmethod
    def parts(c: str, where: Column | None = None) -> dict[str, Column]:
        """What is added up, over the rows ``where`` holds."""
        value = F.col(c) if where is None else F.when(where, F.col(c))
        off = value - F.col(_mu(c))
        return {"n": F.count(value), "d": F.sum(off), "q": F.sum(off * off), "lo": F.min(value), "hi": F.max(value)}

    def values(self, found: dict[str, dict[str, Column]]) -> dict[str, Column]:
        out = {}
        for c in self.cols:
            n, d, q, lo, hi = (found[c][p] for p in ("n", "d", "q", "lo", "hi"))
            mu = F.col(_mu(c))
            spread_sq = F.greatest(q - d * F.try_divide(d, n), F.lit(0.0))
            value = {
                "count": n,
                "sum": F.when(n > 0, d + n * mu),
                "mean": mu + F.try_divide(d, n),
                "std": F.when(n > 1, F.sqrt(F.try_divide(spread_sq, n - 1))),
                "min": lo,
                "max": hi,
            }
            out |= {self.name(c, s): value[s] for s in self.stats}
        return out


def chunk_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    build: Build,
    back: int,
    ahead: int = 0,
    running: Running | None = None,
    hot_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach at most ``back`` / ``ahead`` rows, and running ones."""
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _plain(df, keys, order, tie, build, running)
    cold, heavy = _split(df, keys, hot)
    return _plain(cold, keys, order, tie, build, running).unionByName(
        _chunked(heavy, keys, order, tie, build, back, ahead, chunk_rows, running)
    )


def halo_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    build: Build,
    back: int,
    ahead: int = 0,
    hot_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach at most ``back`` / ``ahead`` rows."""
    return chunk_windows(df, keys, order, tie, build, back, ahead, None, hot_rows, chunk_rows)


def global_halo_windows(
    df: DataFrame, order: str, tie: str, build: Build, back: int, ahead: int = 0, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The same over the whole table as one ordered sequence."""
    return _chunked(df, [], order, tie, build, back, ahead, chunk_rows)


def _chunked(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    build: Build,
    back: int,
    ahead: int,
    chunk_rows: int,
    running: Running | None = None,
) -> DataFrame:
    columns = rows.columns
    numbered = ordered_index(rows, order, tie, keys, name=_INDEX)
    size = max(chunk_rows, back, ahead, 1)
    home = F.floor(F.col(_INDEX) / size).cast("long")
    at = F.col(_INDEX) % size
    seen_by = F.filter(
        F.array(
            home,
            F.when(at >= size - back, home + 1),
            F.when((at < ahead) & (home > 0), home - 1),
        ),
        lambda c: c.isNotNull(),
    )
    numbered = numbered.withColumn(_HOME, home)
    if running is not None:
        # a row for each hot key
        centre = rows.groupBy(*keys).agg(*[F.avg(c).alias(_mu(c)) for c in running.cols])
        numbered = stage(numbered.join(centre, list(keys), "left"), "numbered")
    dealt = numbered.withColumn(_CHUNK, F.explode(seen_by))
    window = Window.partitionBy(*keys, _CHUNK).orderBy(_INDEX)
    made = build(window)
    if running is not None:
        carry = _carry(numbered, keys, running)
        dealt = dealt.join(carry, [*keys, _CHUNK], "left")
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        own = F.col(_CHUNK) == F.col(_HOME)
        found = {}
        for c in running.cols:
            inside = {p: e.over(frame) for p, e in running.parts(c, own).items()}
            before = {p: F.col(f"__fw_c{p}_{c}") for p in inside}
            added = {p: F.coalesce(inside[p], F.lit(0)) + F.coalesce(before[p], F.lit(0)) for p in ("n", "d", "q")}
            found[c] = {**added, "lo": F.least(inside["lo"], before["lo"]), "hi": F.greatest(inside["hi"], before["hi"])}
        made |= running.values(found)
    out = dealt.select(*columns, _CHUNK, _HOME, *[c.alias(n) for n, c in made.items()])
    return out.filter(F.col(_CHUNK) == F.col(_HOME)).drop(_CHUNK, _HOME)


def _carry(numbered: DataFrame, keys: Sequence[str], running: Running) -> DataFrame:
    """What the chunks before each chunk add up to."""
    parts = {(p, c): e for c in running.cols for p, e in running.parts(c).items()}
    sums = numbered.groupBy(*keys, F.col(_HOME).alias(_CHUNK)).agg(*[e.alias(f"__fw_{p}_{c}") for (p, c), e in parts.items()])
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    fold = {"n": F.sum, "d": F.sum, "q": F.sum, "lo": F.min, "hi": F.max}
    return sums.select(*keys, _CHUNK, *[fold[p](f"__fw_{p}_{c}").over(earlier).alias(f"__fw_c{p}_{c}") for p, c in parts])


def running_stats(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    cols: Sequence[str],
    names: Callable[[str, str], str],
    stats: Sequence[str],
    hot_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Running count/sum/mean/std/min/max per key, current row included."""
    return chunk_windows(df, keys, order, tie, lambda _: {}, 0, 0, Running(cols, stats, names), hot_rows, chunk_rows)


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    values: dict[str, str],
    hot_rows: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add, per ``{output: column}``, the last non-null value at or before the row."""

    def build(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {out: F.last(c, ignorenulls=True).over(frame) for out, c in values.items()}

    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _plain(df, keys, order, tie, build)
    cold, heavy = _split(df, keys, hot)
    rows = ordered_index(heavy, order, tie, keys, name=_INDEX)
    rows = stage(rows.withColumn(_CHUNK, F.floor(F.col(_INDEX) / chunk_rows).cast("long")), "numbered")
    newest = rows.groupBy(*keys, _CHUNK).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(_INDEX))).alias(f"__fw_l_{out}")
            for out, c in values.items()
        ]
    )
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = newest.select(
        *keys, _CHUNK, *[F.last(f"__fw_l_{o}", ignorenulls=True).over(earlier).alias(f"__fw_cl_{o}") for o in values]
    )
    rows = rows.join(carry, [*keys, _CHUNK], "left")
    inside = build(Window.partitionBy(*keys, _CHUNK).orderBy(_INDEX))
    made = [F.coalesce(inside[o], F.col(f"__fw_cl_{o}")).alias(o) for o in values]
    return _plain(cold, keys, order, tie, build).unionByName(rows.select(*df.columns, *made))
