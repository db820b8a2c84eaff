"""Folds, time splits and samples.

Fold contract: rows are ordered by md5 of seed and id, within the class where
folds are stratified, and fold ``i`` is the i-th of ``k`` equal blocks, the
first ``n % k`` of them one row longer (``ntile``). The result depends on the
data only, never on partitioning, and equals the same rule in any SQL engine.
Because a block is bounded by hashes, no row moves to get its fold, and rows
with the same id are never separated.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.functions.names import as_list, require
from foldwright.functions.scalars import uniform_from_hash
from foldwright.plans.cuts import hash_cuts, order_cuts, with_block
from foldwright.plans.hot import attach, spread
from foldwright.plans.ranks import ordered_index, seeded_hash
from foldwright.session import stage

FOLD = "fold"


def block_starts(n: int, k: int) -> list[int]:
    """First positions of blocks 1..k-1 when n rows are cut into k blocks."""
    small, extra = divmod(n, k)
    return [i * small + min(i, extra) for i in range(1, k)]


def _starts(k: int):
    """``block_starts`` as a column."""
    return lambda n: F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda i: i * F.floor(n / k) + F.least(i, n % k)) if k > 1 else F.array().cast("array<bigint>")


def kfold(
    df: DataFrame,
    id_cols: str | Sequence[str],
    n_folds: int = 5,
    seed: int = 42,
    exact: bool = True,
    shuffle: bool = True,
) -> DataFrame:
    """Add ``fold``. ``exact=False`` needs no pass over the data at all.

    Without shuffling, folds are consecutive blocks in id order.
    """
    ids = as_list(id_cols)
    require(df, ids)
    if not shuffle:
        tie = ids[1] if len(ids) > 1 else ids[0]
        cuts = order_cuts(df, ids[0], tie, lambda n: block_starts(n, n_folds))
        passed = F.lit(0)
        for start in block_starts(cuts.n, n_folds):
            passed = passed + (~cuts.before(start)).cast("int")
        return df.withColumn(FOLD, passed)
    if not exact:
        return df.withColumn(FOLD, hash_fold(ids, n_folds, seed))
    cuts = hash_cuts(df, seed, ids, _starts(n_folds))
    return with_block(df, cuts, seed, ids, FOLD)


def hash_fold(ids: Sequence[str], n_folds: int, seed: int) -> Column:
    """A fold from the hash alone: sizes are equal only in expectation."""
    lead = F.conv(F.substring(seeded_hash(seed, *ids), 1, 8), 16, 10).cast("long")
    return F.pmod(lead, F.lit(n_folds)).cast("int")


def stratified_kfold(
    df: DataFrame, id_cols: str | Sequence[str], label: str | None, n_folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add ``fold`` with every class spread evenly; plain folds if there is no label."""
    if label is None or label not in df.columns:
        warnings.warn("no label to stratify by; using plain folds")
        return kfold(df, id_cols, n_folds, seed)
    ids = as_list(id_cols)
    cuts = hash_cuts(df, seed, ids, _starts(n_folds), label)
    return with_block(df, cuts, seed, ids, FOLD, label)


def group_kfold(df: DataFrame, group: str, n_folds: int = 5, id_cols: str | Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Add ``fold`` so that no group is in two folds and fold sizes are close.

    Groups are ranked by size and dealt back and forth (0..k-1, k-1..0). A row
    without a group is a group of its own and gets a fold from the hash of its
    ids, or of all its columns where none are named.
    """
    if group is None:
        raise ValueError("grouped folds need a group column")
    require(df, [group])
    # one row per group, read for the limits, the ranks and the hot-key check
    sizes = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("__fw_n"))
    sizes = stage(sizes, "group-sizes")
    ranked = ordered_index(sizes, "__fw_n", group, descending=True, name="__fw_at")
    turn = F.col("__fw_at") % (2 * n_folds)
    folds = ranked.select(
        group, F.when(turn < n_folds, turn).otherwise(2 * n_folds - 1 - turn).cast("int").alias(FOLD)
    )
    return _with_folds(df, folds, sizes, group, n_folds, id_cols, seed)


def _with_folds(
    df: DataFrame, folds: DataFrame, sizes: DataFrame, group: str, n_folds: int, id_cols: str | Sequence[str] | None, seed: int
) -> DataFrame:
    """The folds of the groups, and of rows whose group is null."""
    own = hash_fold(as_list(id_cols), n_folds, seed) if id_cols is not None else spread(df, n_folds) - 1
    # known before the join, which then moves no column that only a hash of all columns reads
    rows = df.withColumn("__fw_own", F.when(F.col(group).isNull(), own))
    out = attach(rows, folds, [group], sizes=sizes)
    return out.withColumn(FOLD, F.when(F.col(group).isNull(), F.col("__fw_own")).otherwise(F.col(FOLD))).drop("__fw_own")


def stratified_group_kfold(
    df: DataFrame, group: str, label: str, n_folds: int = 5, id_cols: str | Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """Whole groups per fold, groups with the same majority class dealt round-robin.

    Labels may be of any type. Rows without a group get folds as in ``group_kfold``.
    """
    from foldwright.operators.groupby import majority_class

    require(df, [group, label])
    majority = stage(majority_class(df, group, label), "group-majority")
    n_groups = majority.count()
    if n_folds > n_groups:
        raise ValueError(f"{n_folds} folds need as many groups; there are {n_groups}")
    # classes by rank, as strings have no numeric order; there are few of them beside the groups
    classes = majority.select("majority").distinct()
    ranks = classes.withColumn("__fw_rank", F.row_number().over(Window.orderBy(F.col("majority").asc_nulls_last())))
    known = majority.join(ranks.withColumnRenamed("majority", "__fw_m"), F.col("majority").eqNullSafe(F.col("__fw_m")))
    ranked = ordered_index(known.select(group, "__fw_rank"), "__fw_rank", group, name="__fw_at")
    folds = ranked.select(group, F.pmod(F.col("__fw_at"), F.lit(n_folds)).cast("int").alias(FOLD))
    sizes = majority.select(group, F.col("n_rows").alias("__fw_n"))
    return _with_folds(df, folds, sizes, group, n_folds, id_cols, seed)


# ---------------------------------------------------------------- time splits


@dataclass(frozen=True)
class Block:
    """Row positions of one split: test is ``[start, end)``, train two open ranges."""

    split: int
    test_start: int
    test_end: int
    train_end: int
    train_restart: int | None = None


def time_blocks(n: int, n_folds: int = 5) -> list[Block]:
    """Ordered test blocks of ``n // (k+1)`` rows at the end, train is all before."""
    size = n // (n_folds + 1)
    first = n - n_folds * size
    return [Block(i, first + i * size, first + (i + 1) * size, first + i * size) for i in range(n_folds)]


def purged_blocks(
    n: int, n_folds: int = 5, purge_gap: int = 0, embargo_pct: float = 0.0, legacy: bool = False
) -> list[Block]:
    """Every block is tested once; training keeps a gap to it on both sides.

    The embargo drops further training rows after the test block. ``legacy``
    moves the start of the test block instead and leaves the remainder rows
    untested, as older results were computed.
    """
    size = n // n_folds
    blocks = []
    for i in range(n_folds):
        start = i * size
        end = start + size if legacy or i < n_folds - 1 else n
        embargo = int((end - start) * embargo_pct)
        if legacy:
            start += embargo
            blocks.append(Block(i, start, end, max(0, start - purge_gap), min(n, end + purge_gap)))
        else:
            blocks.append(Block(i, start, end, max(0, start - purge_gap), min(n, end + purge_gap + embargo)))
    return blocks


def purged_forward_blocks(
    n: int, n_folds: int = 5, purge_gap: int = 0, embargo_pct: float = 0.01
) -> list[Block]:
    """Train strictly before the test block minus the gap; the embargo shortens the test."""
    size = n // (n_folds + 1)
    blocks = []
    for i in range(n_folds):
        start = (i + 1) * size
        end = (i + 2) * size if i < n_folds - 1 else n
        blocks.append(Block(i, start, end - int((end - start) * embargo_pct), max(0, start - purge_gap)))
    return blocks


def split_roles(df: DataFrame, time: str, tie: str, blocks: Callable[[int], Sequence[Block]]) -> DataFrame:
    """One row per (row, split) it takes part in, with ``split`` and ``role``.

    A row can appear in every split, so the table is up to k times as long. Rows
    compare their (time, tie) key with the keys at the block limits.
    """

    def limits(n: int) -> list[int]:
        return [p for b in blocks(n) for p in (b.test_start, b.test_end, b.train_end, b.train_restart) if p is not None]

    cuts = order_cuts(df, time, tie, limits)
    takes = []
    for b in blocks(cuts.n):
        train = cuts.before(b.train_end)
        if b.train_restart is not None:
            train = train | ~cuts.before(b.train_restart)
        test = ~cuts.before(b.test_start) & cuts.before(b.test_end)
        role = F.when(test, "test").when(train, "train")
        takes.append(F.struct(F.lit(b.split).alias("split"), role.alias("role")))
    taken = F.filter(F.array(*takes), lambda t: t["role"].isNotNull())
    return df.withColumn("__fw_r", F.explode(taken)).select(*df.columns, "__fw_r.split", "__fw_r.role")


def time_split(df: DataFrame, time: str, tie: str, n_folds: int = 5) -> DataFrame:
    return split_roles(df, time, tie, lambda n: time_blocks(n, n_folds))


def purged_split(
    df: DataFrame,
    time: str,
    tie: str,
    n_folds: int = 5,
    purge_gap: int = 0,
    embargo_pct: float = 0.0,
    legacy: bool = False,
) -> DataFrame:
    return split_roles(df, time, tie, lambda n: purged_blocks(n, n_folds, purge_gap, embargo_pct, legacy))


def purged_forward_split(
    df: DataFrame, time: str, tie: str, n_folds: int = 5, purge_gap: int = 0, embargo_pct: float = 0.01
) -> DataFrame:
    return split_roles(df, time, tie, lambda n: purged_forward_blocks(n, n_folds, purge_gap, embargo_pct))


# ------------------------------------------------------------------- sampling


def exact_sample(df: DataFrame, id_cols: str | Sequence[str], share: float, seed: int = 42) -> DataFrame:
    """Exactly ``int(n * share)`` rows (ids being unique), first in seeded hash order: a plain filter."""
    if share >= 1.0:
        return df
    ids = as_list(id_cols)
    first = hash_cuts(df, seed, ids, lambda n: F.array(F.floor(n * F.lit(share)).cast("long"))).first()
    limit = first["cuts"][0] if first else None
    return df if limit is None else df.filter(seeded_hash(seed, *ids) < F.lit(limit))


def bootstrap(df: DataFrame, id_cols: str | Sequence[str], seed: int = 42, copies: str = "copies") -> DataFrame:
    """Poisson(1) bootstrap: ``copies`` is how often the row occurs in the bag.

    The hash-based draw needs no shuffle, and the bag is the same on every retry.
    Terms go on until what is left is below one step of the 52-bit uniform.
    """
    u = uniform_from_hash(seed, "bag", *[F.col(c) for c in as_list(id_cols)])
    drawn, cumulative, weight, k = F.lit(0), 0.0, math.exp(-1.0), 0
    while weight >= 2.0**-53:
        cumulative += weight
        drawn = drawn + F.when(u > cumulative, 1).otherwise(0)
        k += 1
        weight /= k
    return df.withColumn(copies, drawn.cast("int")).filter(F.col(copies) > 0)


def feature_bag(features: Sequence[str], share: float, seed: int = 42) -> list[str]:
    """A seeded subset of the columns, in their given order."""
    import hashlib

    order = sorted(features, key=lambda f: hashlib.md5(f"{seed}_{f}".encode()).hexdigest())
    kept = set(order[: max(1, int(len(features) * share))])
    return [f for f in features if f in kept]


def holdout(
    df: DataFrame,
    id_cols: str | Sequence[str],
    label: str | None = None,
    share: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Add ``role``: 'valid' for ``ceil(share * n)`` rows (of each class), else 'train'."""
    by = label if stratify else None
    ids = as_list(id_cols)
    cuts = hash_cuts(df, seed, ids, lambda n: F.array(F.ceil(F.lit(share) * n).cast("long")), by)
    placed = with_block(df, cuts, seed, ids, "__fw_block", by)
    return placed.withColumn("role", F.when(F.col("__fw_block") == 0, "valid").otherwise("train")).drop("__fw_block")


def choose_strategy(
    task: str = "classification", time: str | None = None, group: str | None = None, n_groups: int | None = None
) -> tuple[str, int]:
    """Which split to use by default: time, then group, then stratified, then plain."""
    if time is not None:
        return "time", 5
    if group is not None:
        return "grouped", min(5, n_groups) if n_groups else 5
    return ("stratified", 5) if task == "classification" else ("kfold", 5)


def assign_folds(
    df: DataFrame,
    id_cols: str | Sequence[str],
    strategy: str = "stratified",
    n_folds: int = 5,
    seed: int = 42,
    label: str | None = None,
    group: str | None = None,
    time: str | None = None,
    **options,
) -> DataFrame:
    """Add ``fold`` by the named strategy.

    ``time``, ``purged`` and ``purged_forward`` return the long ``(split, role)``
    table instead, ordered by ``time`` and the first id; ``options`` are theirs.
    """
    if strategy == "kfold":
        return kfold(df, id_cols, n_folds, seed)
    if strategy == "stratified":
        return stratified_kfold(df, id_cols, label, n_folds, seed)
    if strategy == "grouped":
        return group_kfold(df, group, n_folds, id_cols, seed)
    if strategy == "stratified_grouped":
        return stratified_group_kfold(df, group, label, n_folds, id_cols, seed)
    ordered = {"time": time_split, "purged": purged_split, "purged_forward": purged_forward_split}
    if strategy not in ordered:
        raise ValueError(f"no such split strategy: {strategy}")
    if time is None:
        raise ValueError(f"the {strategy} strategy needs a time column")
    return ordered[strategy](df, time, as_list(id_cols)[0], n_folds, **options)
