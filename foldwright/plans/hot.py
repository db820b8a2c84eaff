"""Keys that hold a large share of the rows, and joins that survive them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.plans.size import HOT_ROWS
from foldwright.session import stage

SPREAD = 1_024


def spread(df: DataFrame, ways: int = SPREAD) -> Column:
    """A repeatable row-level salt in ``1..ways`` (results never depend on it)."""
    flat = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*flat), F.lit(ways)).cast("int") + 1


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int | None = None, sizes: DataFrame | None = None
) -> DataFrame | None:
    """Keys of more than ``hot_rows`` rows, one in so many rows at most; None if there are none.

    One pass over the key columns, the same for tables of every size: rows are
    counted by key where they are read, and the keys above the limit, if there are
    any, are written once, so that every later use reads a few rows and knows
    their bytes. A stream has none, as its trigger bounds a micro-batch.
    """
    if df.isStreaming:
        return None
    if sizes is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__fw_n"))
    limit = HOT_ROWS if hot_rows is None else hot_rows
    known = sizes
    for key in keys:
        known = known.filter(F.col(key).isNotNull())
    known = known.filter(F.col("__fw_n") > limit).select(*keys).persist()
    try:
        return None if known.isEmpty() else stage(known, "hot-keys")
    finally:
        known.unpersist()


def attach(
    df: DataFrame,
    state: DataFrame,
    keys: Sequence[str],
    sizes: DataFrame | None = None,
    hot_rows: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Left join of a table with one row per key, safe for hot and null keys.

    ``small`` says that no key of ``df`` can hold enough rows to matter. Callers
    that join several states pass what they found before the first join.

    The plain join lets Spark broadcast ``state`` when its measured size allows.
    When ``df`` is large the rows may have to be shuffled by key, and a hot key
    would then land in one task; Spark's own skew split does not apply because
    the state side is an aggregate. So rows of hot keys are dealt over
    ``SPREAD`` salts and their state is repeated for each, which adds one state
    row for every few thousand rows at most, whatever the width of the state.
    Rows with a null key have nothing to find and are dealt out as well.
    """
    keys = list(keys)
    values = [c for c in state.columns if c not in keys]
    if small or df.isStreaming:
        return df.join(state, keys, "left")
    hot = hot_keys(df, keys, hot_rows, sizes)
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    salt, mark = "__fw_salt", "__fw_hot"
    if hot is None:
        rows = df.withColumn(salt, F.when(has_key, 0).otherwise(-spread(df)))
        return rows.join(state.withColumn(salt, F.lit(0)), [*keys, salt], "left").drop(salt)
    # the hot keys alone, at most one for HOT_ROWS rows; Spark broadcasts them by their written bytes
    rows = df.join(hot.withColumn(mark, F.lit(True)), keys, "left")
    rows = rows.withColumn(salt, F.when(~has_key, -spread(df)).when(F.col(mark), spread(df)).otherwise(0)).drop(mark)
    salts = F.sequence(F.lit(1), F.lit(SPREAD))
    repeated = state.join(hot, keys, "left_semi").withColumn(salt, F.explode(salts))
    both = state.withColumn(salt, F.lit(0)).unionByName(repeated)
    return rows.join(both, [*keys, salt], "left").select(*df.columns, *values)
