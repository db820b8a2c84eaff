"""Feature lookups: overlap counts, membership, merged vectors and as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.functions.names import as_list, require
from foldwright.functions.scalars import uniform_from_hash
from foldwright.plans.chunks import last_known
from foldwright.plans.hot import attach
from foldwright.plans.size import is_small


def overlap(train: DataFrame, test: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """How many (train, test) row pairs agree on all common columns, nulls equal.

    The tables are never joined row by row: both are counted per distinct row
    first, so a row repeated a billion times costs one count.
    """
    common = [c for c in train.columns if c in test.columns and c not in exclude]
    if not common:
        raise ValueError("train and test have no common columns")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = train.select(*common, one.alias("a"), none.alias("b")).unionByName(
        test.select(*common, none.alias("a"), one.alias("b"))
    )
    # grouping treats nulls as equal, which is the comparison wanted here
    counts = both.groupBy(*common).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    shared = (F.col("a") > 0) & (F.col("b") > 0)
    return counts.agg(
        F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("n_pairs"),
        F.count(F.when(shared, 1)).alias("n_distinct"),
        F.coalesce(F.sum(F.when(shared, F.col("a"))), F.lit(0)).alias("n_train_rows"),
        F.coalesce(F.sum(F.when(shared, F.col("b"))), F.lit(0)).alias("n_test_rows"),
    )


def in_groups(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key).distinct(), key, "left_semi")


def not_in_groups(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key).distinct(), key, "left_anti")


def merge_vectors(
    raw: DataFrame, offline: DataFrame, online: DataFrame, entity: str, features: Sequence[str]
) -> DataFrame:
    """One vector per raw row; raw wins over offline, offline over online.

    ``offline`` and ``online`` have one row per entity; any of the three tables
    may lack some features.
    """
    out, small = raw, is_small(raw)
    for side, source in (("off", offline), ("on", online)):
        held = [f for f in features if f in source.columns]
        out = attach(out, source.select(entity, *[F.col(f).alias(f"__fw_{side}_{f}") for f in held]), [entity], small=small)
    made = []
    for f in features:
        order = [f] * (f in raw.columns) + [f"__fw_off_{f}"] * (f in offline.columns) + [f"__fw_on_{f}"] * (f in online.columns)
        made.append(F.coalesce(*[F.col(c) for c in order]).alias(f))
    return out.select(*[c for c in raw.columns if c not in features], *made)


def as_of(
    facts: DataFrame,
    features: DataFrame,
    entity: str | Sequence[str],
    time: str,
    values: Sequence[str],
    fact_id: str,
    feature_tie: str,
    hot_rows: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Per fact the latest feature values at or before its time; never a later one.

    Facts and features are merged into one ordered stream per entity, so the
    cost is one shuffle and one sort however many pairs would match. Both tables
    name the entity and time columns alike.
    """
    entity = as_list(entity)
    require(facts, [*entity, time, fact_id])
    require(features, [*entity, time, *values, feature_tie])
    # of features with equal time, the one with the largest tie counts
    newest = features.groupBy(*entity, time).agg(
        F.max_by(F.struct(*values), F.col(feature_tie)).alias("__fw_v")
    )
    kind = dict(facts.dtypes)
    left = facts.select("*", F.lit(None).cast(newest.schema["__fw_v"].dataType).alias("__fw_v"))
    # features sort before facts of the same time; facts are spread by hash
    left = left.withColumn("__fw_side", 1.0 + uniform_from_hash(0, "asof", F.col(fact_id)))
    others = [F.lit(None).cast(kind[c]).alias(c) for c in facts.columns if c not in (*entity, time)]
    right = newest.select(*entity, time, *others, "__fw_v", F.lit(0.0).alias("__fw_side"))
    extra = {} if chunk_rows is None else {"chunk_rows": chunk_rows}
    merged = last_known(
        left.unionByName(right), entity, time, "__fw_side", {"__fw_last": "__fw_v"}, hot_rows, **extra
    )
    merged = merged.filter(F.col("__fw_side") > 0)
    return merged.select(*facts.columns, *[F.col("__fw_last")[v].alias(v) for v in values])
