"""The paths for large and skewed tables give the same answers as the plain ones."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldwright.operators import encode, groupby, lookup, metrics, splits, windows
from foldwright.operators.groupby import majority_class
from foldwright.plans import cuts as cut_module
from foldwright.plans import ranks as ranks_module
from foldwright.plans.buckets import order_buckets
from foldwright.plans.cuts import hash_cuts, order_cuts
from foldwright.plans.hot import attach, hot_keys
from foldwright.plans.quantiles import group_quantiles, table_quantiles
from foldwright.plans.ranks import ordered_index, seeded_hash


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; key 'hot' and the time 7 each hold a third; values repeat."""
    rng = random.Random(5)
    lines = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}" if i % 50 else None
        time = 7 if rng.random() < 0.34 else rng.randrange(200)
        lines.append((i, key, time, float(rng.randrange(30)) if i % 17 else None, rng.random()))
    return spark.createDataFrame(lines, "id long, g string, t int, v double, s double").cache()


def same(a, b, key="id"):
    one, two = ({r[key]: r.asDict() for r in d.collect()} for d in (a, b))
    assert one.keys() == two.keys()
    for k in one:
        for c in one[k]:
            x, y = one[k][c], two[k][c]
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (k, c, x, y)
            else:
                assert x == y, (k, c, x, y)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partition", [[], ["g"]])
def test_ordered_index_equals_window(skewed, descending, partition):
    first = F.col("t").desc() if descending else F.col("t").asc()
    window = (Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))).orderBy(first, "id")
    want = skewed.select("id", (F.row_number().over(window) - 1).cast("long").alias("index"))
    got = ordered_index(skewed, "t", "id", partition, descending, rows_per_bucket=40).select("id", "index")
    same(want, got)


def _largest_cell(monkeypatch, **options):
    """The rows of the largest cell that ``ordered_index`` sorts in one task, and its result."""
    seen = []
    add = ranks_module._add_offsets

    def watch(placed, keys, places, *rest):
        seen.append(placed.groupBy(*keys, *places).count().agg(F.max("count")).first()[0])
        return add(placed, keys, places, *rest)

    monkeypatch.setattr(ranks_module, "_add_offsets", watch)
    return ordered_index(**options), seen[0]


@pytest.mark.parametrize(
    ("order", "tie", "partition", "descending"),
    [("t", "id", [], True), ("v", "id", ["g"], False), ("s", "id", [], False), ("t", "c", [], False), ("c", "id", ["g"], True)],
)
def test_large_cells_are_cut_until_none_is_left(skewed, monkeypatch, order, tie, partition, descending):
    """One first range only, so every limit comes from the deeper levels; values repeat, and null is one of them."""
    df = skewed.withColumn("c", F.concat(F.lit("c"), F.md5(F.col("id").cast("string"))))
    nulls_last = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    if order == "c":
        nulls_last = F.col(order).desc() if descending else F.col(order).asc()
    window = (Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))).orderBy(nulls_last, tie)
    want = df.select("id", (F.row_number().over(window) - 1).cast("long").alias("index"))
    got, largest = _largest_cell(monkeypatch, df=df, order=order, tie=tie, partition=partition, descending=descending, rows_per_bucket=100_000, cell_rows=60)
    assert largest <= 60
    same(want, got.select("id", "index"))


def test_rows_that_cannot_be_told_apart_end_the_cutting(spark, monkeypatch):
    df = spark.range(500).select("id", F.lit(1).alias("n"), F.lit(2).alias("t"))
    got, largest = _largest_cell(monkeypatch, df=df, order="n", tie="t", rows_per_bucket=100_000, cell_rows=50)
    assert largest == 500
    assert sorted(r["index"] for r in got.collect()) == list(range(500))


def test_positions_within_hot_and_null_keys(skewed):
    window = Window.partitionBy("g").orderBy("t", "id")
    want = skewed.select("id", F.row_number().over(window).cast("long").alias("position"))
    for hot_rows in (None, 500):
        same(want, windows.sequence_in_group(skewed, "g", "t", "id", hot_rows=hot_rows).select("id", "position"))


def test_string_ties_are_cut_as_well(spark):
    df = spark.createDataFrame([(1 if i % 4 else 2, f"c{i:05d}") for i in range(2000)], "n int, c string")
    limits = order_buckets(df, "n", "c", rows_per_bucket=50)
    assert limits.owned and limits.tie_words
    want = df.select("c", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("n", "c")) - 1).cast("long").alias("index"))
    same(want, ordered_index(df, "n", "c", rows_per_bucket=50).select("c", "index"), "c")


def test_no_bucket_keeps_the_hot_value(skewed):
    limits = order_buckets(skewed, "t", "id", rows_per_bucket=50)
    largest = limits.place(skewed).groupBy("__fw_b", "__fw_s").count().agg(F.max("count")).first()[0]
    assert largest < 3000 / 10


def test_order_cuts_are_exact(skewed):
    ordered = [tuple(r) for r in skewed.orderBy("t", "id").select("t", "id").collect()]
    wanted = [0, 1, 999, 1000, 1700, 2999, 3000]
    found = order_cuts(skewed, "t", "id", lambda n: wanted, rows_per_bucket=40)
    for p in wanted:
        assert skewed.filter(found.before(p)).count() == p
        if 0 < p < 3000:
            assert found.keys[p] == ordered[p]


def test_order_cuts_with_null_order(skewed):
    found = order_cuts(skewed, "v", "id", lambda n: [100, 2900], rows_per_bucket=100)
    assert [skewed.filter(found.before(p)).count() for p in (100, 2900)] == [100, 2900]


@pytest.mark.parametrize("limit", [1_000_000, 100, 1])
def test_hash_cuts_are_exact(skewed, monkeypatch, limit):
    """A tiny bucket limit counts by longer prefixes."""
    monkeypatch.setattr(cut_module, "BUCKET_ROWS", limit)
    hashes = sorted(r[0] for r in skewed.select(seeded_hash(3, "id")).collect())
    wanted = [0, 10, 1500, 2999, 3000]
    found = hash_cuts(skewed, 3, ["id"], lambda n: F.array(*[F.lit(w).cast("long") for w in wanted])).collect()
    assert [(r["n"], r["cuts"]) for r in found] == [(3000, [*(hashes[p] for p in wanted[:-1]), None])]


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_hash_cuts_by_class(spark, monkeypatch, limit):
    """Classes of very different sizes, null among them, at one level of cells and at several."""
    monkeypatch.setattr(cut_module, "BUCKET_ROWS", limit)
    df = spark.range(3000).selectExpr("id", "case when id % 3 > 0 then 'a' when id % 30 = 0 then null else concat('c', id % 7) end as y")
    hashes: dict = {}
    for label, hashed in df.select("y", seeded_hash(3, "id")).collect():
        hashes.setdefault(label, []).append(hashed)
    found = hash_cuts(df, 3, ["id"], splits._starts(4), "y").collect()
    want = {y: (len(h), [sorted(h)[i] for i in splits.block_starts(len(h), 4)]) for y, h in hashes.items()}
    assert {r[0]: (r["n"], r["cuts"]) for r in found} == want


def test_positions_over_both_clock_changes(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for start in (1710050400, 1730606400):  # hours around the changes of March and November 2024
            df = spark.range(600).select("id", F.timestamp_seconds(F.lit(start) + F.col("id") * 60).alias("t"))
            placed = ordered_index(df, "t", "id", rows_per_bucket=20)
            assert placed.filter("index <> id").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_hash_cuts_with_repeated_and_null_ids(spark, monkeypatch, limit):
    monkeypatch.setattr(cut_module, "BUCKET_ROWS", limit)
    wanted = lambda n: F.array(*[F.lit(w).cast("long") for w in (0, 500, 1999)])
    for df in (spark.range(2000).selectExpr("7 as id"), spark.range(2000).selectExpr("cast(null as long) as id")):
        hashed = df.select(seeded_hash(3, "id")).first()[0]
        assert hash_cuts(df, 3, ["id"], wanted).first()["cuts"] == [hashed] * 3
        assert splits.kfold(df, "id", 5).count() == 2000
    apart = spark.createDataFrame([("a_b", "c"), ("a", "b_c"), ("a", None), (None, "a")], "x string, y string")
    assert apart.select(seeded_hash(1, "x", "y").alias("h")).distinct().count() == 4


def test_many_classes(spark):
    df = spark.range(15_000).selectExpr("id", "concat('c', id % 3000) as y")
    folds = splits.stratified_kfold(df, "id", "y", n_folds=5).groupBy("y").agg(F.count_distinct("fold").alias("n"), F.max("fold").alias("m"))
    assert folds.agg(F.min("n"), F.max("m")).first() == (5, 4)


def test_order_cuts_refine(skewed, monkeypatch):
    monkeypatch.setattr(cut_module, "BUCKET_ROWS", 20)
    ordered = [(r[0], r[1]) for r in skewed.select("v", "id").filter("v is not null").orderBy("v", "id").collect()]
    wanted = [1, 500, 1499, 2000]
    found = order_cuts(skewed.filter("v is not null"), "v", "id", lambda n: wanted, rows_per_bucket=400)
    assert [found.keys[p] for p in wanted if p < len(ordered)] == [ordered[p] for p in wanted if p < len(ordered)]


@pytest.mark.parametrize("descending", [False, True])
def test_positions_of_strings(spark, descending):
    rows = [(f"id{(i * 7919) % 3000}" if i % 50 else None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "s string, t int")
    placed = {r["t"]: r["index"] for r in ordered_index(df, "s", "t", descending=descending, rows_per_bucket=50).collect()}
    known = sorted((r for r in rows if r[0]), key=lambda r: r[1])
    known = sorted(known, key=lambda r: r[0], reverse=descending)
    none = [r for r in rows if not r[0]]
    wanted = [*none, *known] if descending else [*known, *none]
    assert placed == {r[1]: i for i, r in enumerate(wanted)}


def test_null_groups_and_string_labels(spark):
    rows = [(i, None if i % 10 == 0 else f"g{i % 37}", f"label{i % 3}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, y string")
    for out in (splits.group_kfold(df, "g", 4, "id"), splits.stratified_group_kfold(df, "g", "y", 4, "id"), splits.group_kfold(df, "g", 4)):
        folds = out.collect()
        assert len(folds) == 400 and all(r["fold"] in range(4) for r in folds)
        assert len({(r["g"], r["fold"]) for r in folds if r["g"]}) == len({r["g"] for r in folds if r["g"]})
        assert len({r["fold"] for r in folds if r["g"] is None}) > 1
    majority = {r["g"]: r["majority"] for r in majority_class(df, "g", "y").collect()}
    for g in majority:
        counts = collections.Counter(y for _, h, y in rows if h == g)
        assert majority[g] == min(counts, key=lambda y: (-counts[y], y))


def test_attach_hot_and_null_keys(skewed):
    state = skewed.filter("g is not null and g <> 'k3'").groupBy("g").agg(F.sum("s").alias("x"), F.max("v").alias("y"))
    plain = skewed.join(state, "g", "left").select("id", "x", "y")
    assert hot_keys(skewed, ["g"], 500).collect()[0][0] == "hot"
    same(plain, attach(skewed, state, ["g"], hot_rows=500).select("id", "x", "y"))
    same(plain, attach(skewed, state, ["g"], hot_rows=5000).select("id", "x", "y"))


def test_group_quantiles_hot_equals_plain(skewed):
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    plain = group_quantiles(skewed.filter("g is not null"), ["g"], ["v", "s"], shares)
    hot = group_quantiles(skewed.filter("g is not null"), ["g"], ["v", "s"], shares, hot_rows=30)
    one = {r["g"]: r for r in plain.collect()}
    two = {r["g"]: r for r in hot.collect()}
    assert one.keys() == two.keys()
    for g in one:
        assert one[g]["v"] == pytest.approx(two[g]["v"])
        assert one[g]["s"] == pytest.approx(two[g]["s"])


def test_table_quantiles_equal_numpy(skewed):
    shares = [0.0, 0.1, 0.5, 0.99, 1.0]
    pdf = skewed.toPandas()
    got = table_quantiles(skewed, ["v", "s", "t"], shares)
    for c in ("v", "s", "t"):
        assert got[c] == pytest.approx(np.quantile(pdf[c].dropna(), shares))
    empty = skewed.filter("id < 0")
    assert table_quantiles(empty, ["v"], [0.5]) == {"v": [None]}


def test_windows_hot_equals_plain(skewed):
    keep = [c for c in skewed.columns if c != "id"]
    stats = ["mean", "std", "sum", "min", "max"]
    for hot, chunk in ((500, 64), (20, 32)):
        options = dict(hot_rows=hot, chunk_rows=chunk)
        same(
            windows.rolling_features(skewed, "g", ["v"], "t", "id", [3, 20], stats, 2).drop(*keep),
            windows.rolling_features(skewed, "g", ["v"], "t", "id", [3, 20], stats, 2, **options).drop(*keep),
        )
        same(
            windows.expanding_features(skewed, "g", ["v"], "t", "id", [*stats, "count"]).drop(*keep),
            windows.expanding_features(skewed, "g", ["v"], "t", "id", [*stats, "count"], **options).drop(*keep),
        )
        same(
            windows.lag_features(skewed, "g", ["v"], "t", "id", [1, 9]).drop(*keep),
            windows.lag_features(skewed, "g", ["v"], "t", "id", [1, 9], **options).drop(*keep),
        )


def _dense(spark, n: int = 4000):
    """One key, one week, instants that repeat, nulls, and one instant that holds a tenth of the rows."""
    rng = random.Random(8)
    lines = []
    for i in range(n):
        second = 1_704_067_200 + (250_000 if i % 10 == 0 else rng.randrange(7 * 86_400) if i % 3 else rng.randrange(86_400))
        lines.append((i, "one" if i % 50 else None if i % 100 else "two", second, None if i % 13 == 0 else rng.gauss(1e6, 3), float(i % 7)))
    df = spark.createDataFrame(lines, "id long, g string, second long, v double, w double")
    return df.withColumn("t", F.timestamp_seconds("second")).drop("second")


def test_calendar_windows_of_a_dense_key(spark):
    """All kinds of frames: inside a chunk, over one limit, over many chunks, from before the first row."""
    df = _dense(spark).cache()
    stats = ("mean", "std", "sum", "min", "max", "count")
    for days, chunk in (((1, 3, 30), 16), ((2,), 10_000)):
        plain = windows.calendar_rolling(df, "g", ["v", "w"], "t", days, stats).drop("t", "g")
        same(plain, windows.calendar_rolling(df, "g", ["v", "w"], "t", days, stats, hot_rows=1000, chunk_rows=chunk).drop("t", "g"))


def test_no_task_of_a_calendar_window_holds_more_than_a_chunk(spark, monkeypatch):
    from foldwright.plans import spans

    seen = []
    numbered = spans._instants

    def watch(rows, keys, sums, chunk_rows):
        out = numbered(rows, keys, sums, chunk_rows)
        seen.append(out.groupBy(*keys, "__fw_c").count().agg(F.max("count"), F.count("*")).first())
        return out

    monkeypatch.setattr(spans, "_instants", watch)
    windows.calendar_rolling(_dense(spark), "g", ["v"], "t", (7,), ("sum",), hot_rows=1000, chunk_rows=32).collect()
    assert seen[0][0] == 32 and seen[0][1] > 50


def test_blocks_make_up_every_stretch_once(spark):
    from foldwright.plans.spans import _blocks

    pairs = [(a, b) for a in range(20) for b in range(a, 41)]
    for r in spark.createDataFrame(pairs, "a long, b long").withColumn("x", _blocks(F.col("a"), F.col("b"), 6)).collect():
        met = sorted(c for k in r.x for c in range(k.node << k.level, (k.node + 1) << k.level))
        assert met == list(range(r.a, r.b)) and len(r.x) <= 12


def test_series_features_take_one_shuffle_and_equal_the_separate_ones(skewed):
    out = windows.series_features(skewed.withColumn("d", F.timestamp_seconds(F.col("t") * 86_400)), "g", "d", "id", "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    rows = skewed.withColumn("d", F.timestamp_seconds(F.col("t") * 86_400))
    wide = [windows.series_features(rows, "g", "d", "id", "v", hot_rows=h).drop("d", "t", "s") for h in (None, 500)]
    same(*wide)


def test_as_of_against_brute_force(spark):
    rng = random.Random(9)
    facts = [(i, "hot" if i % 2 else f"e{i % 7}", rng.randrange(60)) for i in range(400)]
    feats = [(i, "hot" if i % 2 else f"e{i % 9}", rng.randrange(60), rng.random()) for i in range(200)]
    want = {}
    for i, e, t in facts:
        known = [(ft, fid, v) for fid, fe, ft, v in feats if fe == e and ft <= t]
        want[i] = max(known)[2] if known else None
    f = spark.createDataFrame(facts, "id long, e string, t int")
    x = spark.createDataFrame(feats, "fid long, e string, t int, v double")
    for options in ({}, {"hot_rows": 20, "chunk_rows": 16}):
        out = lookup.as_of(f, x, "e", "t", ["v"], "id", "fid", **options)
        assert {r["id"]: r["v"] for r in out.collect()} == want


def test_auc_against_brute_force(skewed):
    pdf = skewed.withColumn("y", (F.col("t") > 60).cast("int")).select("y", "v").dropna().toPandas()
    pos, neg = pdf.v[pdf.y == 1].to_numpy(), pdf.v[pdf.y == 0].to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    rows = skewed.withColumn("y", (F.col("t") > 60).cast("int"))
    got = metrics.auc(rows, "y", "v", rows_per_bucket=50).first()["auc"]
    assert got == pytest.approx(wins / (len(pos) * len(neg)))
    flipped = metrics.auc(rows.withColumn("v", -F.col("v")), "y", "v").first()["auc"]
    assert flipped == pytest.approx(1 - got)


def test_results_do_not_depend_on_partitions(spark, skewed):
    def run(df):
        folded = splits.stratified_kfold(df.withColumn("y", (F.col("t") > 60).cast("int")), "id", "y", 4)
        out = encode.oof_target_encode(folded, ["g"], "y")
        out = groupby.group_features(out, "g", ["v"], ["mean", "median", "nunique"])
        return windows.rolling_features(out, "g", ["v"], "t", "id", [5], ["mean"]).drop("g", "t", "v", "s")

    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("1", "4", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(run(skewed.repartition(int(parts))).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tables = [{r["id"]: tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in lines} for lines in results]
    assert tables[0] == tables[1] == tables[2]


def test_fold_properties(skewed):
    rows = skewed.withColumn("y", (F.col("t") > 60).cast("int"))
    plain = [r["count"] for r in splits.kfold(rows, "id", 7).groupBy("fold").count().collect()]
    assert len(plain) == 7 and max(plain) - min(plain) <= 1
    for r in (
        splits.stratified_kfold(rows, "id", "y", 7).groupBy("y", "fold").count().groupBy("y")
        .agg((F.max("count") - F.min("count")).alias("d"), F.count("fold").alias("k")).collect()
    ):
        assert r["d"] <= 1 and r["k"] == 7
    grouped = splits.group_kfold(rows, "g", 5)
    assert grouped.filter("g is not null").groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0
    assert splits.exact_sample(rows, "id", 0.137).count() == int(3000 * 0.137)
    held = splits.holdout(rows, "id", "y", 0.2).filter("role = 'valid'").groupBy("y").count().collect()
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    assert {r["y"]: r["count"] for r in held} == {y: math.ceil(0.2 * n) for y, n in sizes.items()}


def test_purge_zone_is_empty(skewed):
    out = splits.purged_split(skewed, "t", "id", 5, purge_gap=30, embargo_pct=0.1)
    at = {r[0]: i for i, r in enumerate(skewed.orderBy("t", "id").select("id").collect())}
    seen = {}
    for r in out.collect():
        seen.setdefault((r["split"], r["role"]), []).append(at[r["id"]])
    tested = sorted(i for (_, role), ids in seen.items() if role == "test" for i in ids)
    assert tested == list(range(3000))
    for k in range(5):
        low, high = min(seen[(k, "test")]), max(seen[(k, "test")])
        assert all(i < low - 30 or i > high + 30 + 59 for i in seen[(k, "train")])


def test_overlap_counts_pairs(spark):
    train = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "x int, y string")
    test = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), (None, 2)], "y string, x int")
    assert tuple(lookup.overlap(train, test).first()) == (7, 2, 3, 4)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_order_cuts_and_days_in_another_time_zone(spark, kind):
    """Values near a clock change keep their order and distance."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = F.concat(F.lit("2024-03-"), F.lpad((F.col("id") % 25 + 1).cast("string"), 2, "0"), F.lit(" 12:30:00"))
        df = spark.range(300).withColumn("t", text.cast(kind)).withColumn("g", F.col("id") % 3)
        found = order_cuts(df, "t", "id", lambda n: [50, 131, 250], rows_per_bucket=20)
        assert [df.filter(found.before(p)).count() for p in (50, 131, 250)] == [50, 131, 250]
        if kind != "date":
            days = windows.days_since_previous(df.filter("id < 25").withColumn("g", F.lit(1)), "g", "t", "id")
            # the clock change leaves 23 hours between two instants
            assert {r["days_since_previous"] for r in days.collect()} == ({None, 0, 1} if kind == "timestamp" else {None, 1})
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
