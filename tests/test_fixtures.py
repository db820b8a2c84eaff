"""Small hand-computed cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from foldwright.functions import vectors
from foldwright.functions.scalars import nan_to_null
from foldwright.operators import blend, encode, groupby, metrics, monitor, prep, pseudo, splits, windows
from foldwright.sources import sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [(1, "A", 1), (2, "B", 0), (3, "A", 1), (4, "B", 0), (5, "C", 1)], "id long, category string, target int"
    )


def value_of(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


# ------------------------------------------------------------------ encoders


def test_unseen_category_gets_global_mean(spark, sample):
    state = encode.fit_target(sample, "category", "target")
    unseen = spark.createDataFrame([(9, "D"), (10, None)], "id long, category string")
    out = encode.apply_target(unseen, state, "category")
    assert value_of(out, "id", "category_target_enc") == pytest.approx({9: 0.6, 10: 0.6})


@pytest.mark.parametrize("smoothing", [0.0, 1.0, 10.0])
def test_no_nulls_for_any_smoothing(sample, smoothing):
    out = encode.apply_target(sample, encode.fit_target(sample, "category", "target", smoothing), "category")
    assert out.count() == 5
    assert out.filter("category_target_enc is null").count() == 0


def test_smoothing_formula(sample):
    state = value_of(encode.fit_target(sample, "category", "target", 2.0), "category", "value")
    assert state["A"] == pytest.approx((2 + 2 * 0.6) / 4)
    assert state["B"] == pytest.approx((0 + 2 * 0.6) / 4)


def test_null_and_nan(spark):
    df = spark.createDataFrame(
        [(1, "A", 1.0), (2, "A", float("nan")), (3, None, 0.0), (4, "B", None), (5, "B", 1.0), (6, None, 1.0)],
        "id long, category string, target double",
    )
    df = nan_to_null(df)
    state = encode.fit_target(df, "category", "target", 1.0)
    out = value_of(encode.apply_target(df, state, "category"), "id", "category_target_enc")
    assert out[3] == out[6] == pytest.approx(0.75)
    assert out[1] == pytest.approx((1 + 0.75) / 2)
    counts = encode.apply_counts(df, encode.fit_counts(df, "category"), "category")
    assert value_of(counts, "id", "category_count_enc")[3] == 0
    ranks = encode.apply_frequency(df, encode.fit_frequency(df, "category"), "category")
    assert value_of(ranks, "id", "category_freq_enc") == {1: 1.0, 2: 1.0, 4: 2.0, 5: 2.0, 3: 3.0, 6: 3.0}
    grouped = groupby.group_features(df, "category", ["target"], ["mean"])
    assert value_of(grouped, "id", "target_mean_by_category")[3] is None


def test_category_in_one_fold_gets_training_mean(spark):
    df = spark.createDataFrame(
        [(1, "A", 1, 0), (2, "A", 0, 0), (3, "B", 1, 1), (4, "B", 1, 0), (5, "B", 0, 1)],
        "id long, category string, y int, fold int",
    )
    out = value_of(encode.oof_target_encode(df, "category", "y", smoothing=1.0), "id", "category_target_enc")
    # fold 0 trains on rows 3 and 5: mean 0.5; A is unseen there
    assert out[1] == out[2] == pytest.approx(0.5)
    assert out[4] == pytest.approx((1 + 0.5) / 3)
    # fold 1 trains on rows 1, 2, 4: mean 2/3
    assert out[3] == pytest.approx((1 + 2 / 3) / 2)


def test_two_columns_are_both_encoded(spark):
    df = spark.createDataFrame(
        [(i, "xy"[i % 2], "uvw"[i % 3], int(i % 2 == 0), i % 3) for i in range(12)],
        "id long, a string, b string, y int, fold int",
    )
    out = encode.oof_target_encode(df, ["a", "b"], "y", smoothing=1.0)
    assert out.select("a_target_enc").distinct().count() > 1
    assert out.filter("b_target_enc = 0").count() == 0


def test_single_key_group_target_differs_from_global(sample):
    out = value_of(encode.group_target(sample, "category", "target", 1.0), "id", "target_encoded_by_category")
    assert out[1] == pytest.approx((2 + 0.6) / 3)
    assert out[2] == pytest.approx(0.6 / 3)


def test_oof_value_ignores_own_target(spark):
    def run(y3):
        df = spark.createDataFrame(
            [(1, "A", 1, 0), (2, "A", 0, 1), (3, "A", y3, 0), (4, "B", 1, 1)], "id long, c string, y int, fold int"
        )
        return value_of(encode.oof_target_encode(df, "c", "y"), "id", "c_target_enc")

    assert run(0)[3] == run(1)[3]
    assert run(0)[2] != run(1)[2]


def test_count_encoder_unknowns(spark, sample):
    state = encode.fit_counts(sample, "category", min_count=2)
    other = spark.createDataFrame([(1, "A"), (2, "C"), (3, "Z"), (4, None)], "id long, category string")
    lowest = value_of(encode.apply_counts(other, state, "category"), "id", "category_count_enc")
    assert lowest == {1: 2, 2: 2, 3: 2, 4: 0}
    zero = value_of(encode.apply_counts(other, state, "category", "zero"), "id", "category_count_enc")
    assert zero == {1: 2, 2: 0, 3: 0, 4: 0}
    with pytest.raises(ValueError, match="Unknown category"):
        encode.apply_counts(other, state, "category", "error")


def test_frequency_ties_by_category(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacd"], "c string")
    assert rows(encode.frequency_ranks(df, "c"), "rank") == [("a", 2, 1), ("b", 2, 2), ("c", 1, 3), ("d", 1, 4)]
    assert rows(encode.frequency_ranks(df, "c", ascending=True), "rank")[0] == ("c", 1, 1)


def test_noise_is_repeatable(sample):
    folded = sample.withColumn("fold", (F.col("id") % 2).cast("int"))
    options = dict(noise=0.1, id_cols="id")
    one = value_of(encode.oof_target_encode(folded, "category", "target", **options), "id", "category_target_enc")
    two = value_of(encode.oof_target_encode(folded, "category", "target", **options), "id", "category_target_enc")
    assert one == two


def test_missing_columns(sample):
    with pytest.raises(ValueError, match="no column"):
        encode.fit_target(sample, "nope", "target")
    state = encode.fit_target(sample, "category", "target")
    with pytest.warns(UserWarning):
        assert encode.apply_target(sample, state, ["nope"]).columns == sample.columns
    with pytest.raises(ValueError):
        encode.apply_target(sample, state, ["nope"], handle_unknown="error")


# -------------------------------------------------------------------- groups


def test_group_docstring_case(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("B", 4)], "category string, value int")
    out = groupby.group_features(df, "category", ["value"], ["mean", "std"])
    first = out.filter("value = 1").first().asDict()
    assert first["value_mean_by_category"] == 1.5
    assert first["value_std_by_category"] == pytest.approx(math.sqrt(0.5))
    assert first["value_diff_from_mean_by_category"] == -0.5
    assert first["value_ratio_to_mean_by_category"] == pytest.approx(1 / (1.5 + 1e-8))


def test_one_row_group(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("B", 4.0)], "g string, v double")
    got = groupby.group_features(df, "g", ["v"]).filter("g = 'A'").first().asDict()
    assert got["v_std_by_g"] is None
    assert got["v_median_by_g"] == 1.0
    assert got["v_nunique_by_g"] == 1


def test_mean_of_minus_floor_gives_null(spark):
    df = spark.createDataFrame([("A", -1e-8), ("A", -1e-8)], "g string, v double")
    out = groupby.group_features(df, "g", ["v"], ["mean"])
    assert [r["v_ratio_to_mean_by_g"] for r in out.collect()] == [None, None]


def test_hierarchical_prefixes(spark):
    df = spark.createDataFrame(
        [(i, "ab"[i % 2], "cd"[i // 2 % 2], "ef"[i // 4], float(i)) for i in range(8)],
        "id long, x string, y string, z string, v double",
    )
    out = groupby.group_features(df, ["x", "y", "z"], ["v"], ["mean"], hierarchical=True)
    assert {"v_mean_by_x", "v_mean_by_x_y", "v_mean_by_x_y_z"} <= set(out.columns)
    assert len(out.columns) == len(set(out.columns))
    assert out.count() == 8


def test_unknown_aggregation_raises(spark):
    df = spark.createDataFrame([("A", 1.0)], "g string, v double")
    with pytest.raises(ValueError):
        groupby.group_features(df, "g", ["v"], ["nonsense"])
    with pytest.raises(ValueError):
        groupby.group_features(df, "missing", ["v"])
    with pytest.warns(UserWarning):
        groupby.group_features(df.select("g"), "g")


def test_user_columns_named_like_helpers(spark):
    """Inputs may use plain names such as n, t, q or category."""
    df = spark.createDataFrame(
        [(i, "uv"[i % 2], i % 3, float(i), i % 2) for i in range(12)], "n long, category string, t int, q double, fold int"
    )
    out = groupby.group_features(df, ["category", "t"], ["q", "n"])
    assert out.count() == 12
    df = df.withColumn("y", (F.col("q") > 5).cast("int"))
    assert encode.oof_target_encode(df, ["category", "t"], "y").count() == 12
    assert encode.group_target(df, ["t"], "y").count() == 12
    assert metrics.auc(df, "y", "q", ["t"]).count() == 3
    medians = groupby.group_stats(df, ["t"], ["q", "n"], ["median"], lambda c, s: f"{c}_{s}", hot_rows=1)
    assert rows(medians.select("t", "q_median"), "t") == [(0, 4.5), (1, 5.5), (2, 6.5)]


def test_mode_and_majority_ties(spark):
    df = spark.createDataFrame([("a", 2), ("a", 2), ("a", 1), ("a", 1), ("b", 3)], "g string, v int")
    assert rows(groupby.group_mode(df, ["g"], "v"), "g") == [("a", 1), ("b", 3)]
    assert rows(groupby.majority_class(df, "g", "v").select("g", "majority"), "g") == [("a", 1), ("b", 3)]


# ------------------------------------------------------------------- windows


def test_time_ties_follow_the_tie_column(spark):
    df = spark.createDataFrame([(4, "s", 1, 4.0), (3, "s", 1, 3.0), (2, "s", 1, 2.0), (1, "s", 0, 1.0)], "id long, g string, t int, v double")
    out = windows.lag_features(df, "g", ["v"], "t", "id", [1])
    assert value_of(out, "id", "v_lag1_by_g") == {1: None, 2: 1.0, 3: 2.0, 4: 3.0}
    out = windows.rolling_features(df, "g", ["v"], "t", "id", [2], ["sum"])
    assert value_of(out, "id", "v_rolling2_sum_by_g") == {1: 1.0, 2: 3.0, 3: 5.0, 4: 7.0}


def test_min_periods_and_null_key(spark):
    df = spark.createDataFrame([(1, "s", 1, 1.0), (2, "s", 2, None), (3, "s", 3, 3.0), (4, None, 4, 4.0)], "id long, g string, t int, v double")
    out = windows.rolling_features(df, "g", ["v"], "t", "id", [3], ["mean"], min_periods=2)
    assert value_of(out, "id", "v_rolling3_mean_by_g") == {1: None, 2: None, 3: 2.0, 4: None}
    with pytest.warns(UserWarning):
        same = windows.rolling_features(df, "g", ["v"], "t", "id", [3], ["nonsense"])
    assert same.columns == df.columns


def test_elapsed_days_round_down(spark):
    df = spark.createDataFrame([(1, "2024-01-01 12:00:00"), (2, "2024-01-02 11:59:59"), (3, "2024-01-04 12:00:00")], "id long, s string")
    df = df.withColumn("t", F.col("s").cast("timestamp_ntz")).withColumn("g", F.lit(1))
    out = windows.days_since_previous(df, "g", "t", "id")
    assert value_of(out, "id", "days_since_previous") == {1: None, 2: 0, 3: 2}


# -------------------------------------------------------------------- splits


def test_purged_bounds_by_hand():
    strict = splits.purged_blocks(11, 3, purge_gap=1, embargo_pct=0.5)
    assert [(b.test_start, b.test_end, b.train_end, b.train_restart) for b in strict] == [(0, 3, 0, 5), (3, 6, 2, 8), (6, 11, 5, 11)]
    legacy = splits.purged_blocks(11, 3, purge_gap=1, embargo_pct=0.5, legacy=True)
    assert [(b.test_start, b.test_end, b.train_end, b.train_restart) for b in legacy] == [(1, 3, 0, 4), (4, 6, 3, 7), (7, 9, 6, 10)]


def test_forward_bounds_by_hand():
    blocks = splits.purged_forward_blocks(11, 2, purge_gap=1, embargo_pct=0.5)
    assert [(b.test_start, b.test_end, b.train_end) for b in blocks] == [(3, 5, 2), (6, 9, 5)]


def test_more_folds_than_groups(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "g int, y int")
    with pytest.raises(ValueError, match="need as many groups"):
        splits.stratified_group_kfold(df, "g", "y", 3)


# ------------------------------------------------------------------- metrics


def test_auc_half_credit_for_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1), (1, 0.1), (0, 0.05)], "y int, s double")
    # pairs won: 3 + 1.5 + ... counted by hand: (3 + 2.5 + 1.5) / 9
    assert metrics.auc(df, "y", "s").first()["auc"] == pytest.approx((3 + 2.5 + 1.5) / 9)


def test_auc_constant_and_one_class(spark):
    same = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "y int, s double")
    assert metrics.auc(same, "y", "s").first()["auc"] == 0.5
    one = spark.createDataFrame([(1, 0.1), (1, 0.5)], "y int, s double")
    assert metrics.auc(one, "y", "s").first()["auc"] is None


def test_auc_error_example(spark):
    df = spark.createDataFrame([(0.85, 1000, 9000)], "auc double, n_pos long, n_neg long")
    a, p, n = 0.85, 1000, 9000
    want = math.sqrt((a * (1 - a) + (p - 1) * (a / (2 - a) - a * a) + (n - 1) * (2 * a * a / (1 + a) - a * a)) / (p * n))
    assert metrics.auc_error(df).first()["auc_se"] == pytest.approx(want)


def test_correlation_needs_three_rows(spark):
    with pytest.raises(ValueError):
        metrics.correlation_report(spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double"), "x", "y")


def test_correlation_p_values_of_many_rows():
    for n in (10**7 - 10, 10**7 + 10, 10**12):
        for t in (0.001, 1.0, 2.0, 6.0):
            r = t / math.sqrt(n - 2 + t * t)
            assert metrics.correlation_p(r, n) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=2e-4 if n < 10**8 else 1e-6)


def test_correlation_p_values():
    # two-sided p of r = 0.8, n = 10: t = 3.771, 8 degrees of freedom
    assert metrics.correlation_p(0.8, 10) == pytest.approx(0.005456, abs=2e-6)
    assert metrics.correlation_p(0.0, 10) == pytest.approx(1.0)
    assert metrics.correlation_p(1.0, 10) == 0.0


# ------------------------------------------------------------ blends, vectors


def test_geometric_mean_with_zero(spark):
    df = spark.createDataFrame([(0.0, 0.5), (0.2, 0.8)], "a double, b double")
    out = [r["blend"] for r in blend.blend(df, ["a", "b"], method="geometric").orderBy("a").collect()]
    assert out == [0.0, pytest.approx(0.4)]


def test_zero_weights_raise(spark):
    df = spark.createDataFrame([(0.1, 0.2)], "a double, b double")
    with pytest.raises(ValueError):
        blend.blend(df, ["a", "b"], {"a": 0.0, "b": 0.0})


def test_median_of_even_and_odd(spark):
    df = spark.createDataFrame([(1.0, 4.0, 2.0, 8.0)], "a double, b double, c double, d double")
    assert blend.blend(df, list("abcd"), method="median").first()["blend"] == 3.0
    assert blend.blend(df, list("abc"), method="median").first()["blend"] == 2.0


def test_vector_functions(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3],)], "p array<double>")
    p = F.col("p")
    got = df.select(
        vectors.argmax(p).alias("at"),
        vectors.argmax_label(p, ["x", "y", "z"]).alias("label"),
        vectors.temperature_scale(p, 1.0).alias("same"),
        vectors.power_scale(p, 2.0).alias("soft"),
        vectors.one_hot(F.lit(2), 3).alias("hot"),
        vectors.mean_of_arrays([p, vectors.one_hot(F.lit(0), 3)], [3.0, 1.0]).alias("mean"),
    ).first()
    assert (got["at"], got["label"], got["hot"]) == (1, "y", [0.0, 0.0, 1.0])
    assert got["same"] == pytest.approx([0.2, 0.5, 0.3], abs=1e-7)
    roots = [math.sqrt(v) for v in (0.2, 0.5, 0.3)]
    assert got["soft"] == pytest.approx([v / sum(roots) for v in roots])
    assert got["mean"] == pytest.approx([0.4, 0.375, 0.225])


def test_threshold_keeps_the_equal_one(spark):
    df = spark.createDataFrame([(1, 0.89), (2, 0.9), (3, 0.95), (4, 0.1)], "id long, confidence double")
    assert [r["id"] for r in pseudo.confident(df, 0.9).orderBy("id").collect()] == [2, 3]


# ------------------------------------------------------- monitoring, prep, io


def test_psi_missing_bins(spark):
    kind = "feature string, bin int, share double"
    ref = spark.createDataFrame([("f", 0, 0.5), ("f", 1, 0.5)], kind)
    cur = spark.createDataFrame([("f", 1, 0.4), ("f", 2, 0.6)], kind)

    def term(c, r):
        return (c - r) * math.log(c / r)

    both = monitor.psi(ref, cur).first()
    assert both["psi"] == pytest.approx(term(0.001, 0.5) + term(0.4, 0.5) + term(0.6, 0.001))
    assert both["drift_detected"]
    strict = monitor.psi(ref, cur, strict=True).first()
    assert strict["psi"] == pytest.approx(term(0.001, 0.5) + term(0.4, 0.5))


def test_narrow_types_exact_bounds(spark):
    df = spark.createDataFrame([(127, 128, 2**31, 0.1, True), (-128, 0, 0, 0.5, False)], "a long, b long, c long, d double, e boolean")
    narrowed, report = prep.narrow_types(df, floats=True)
    assert dict(narrowed.dtypes) == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "double", "e": "boolean"}
    assert report.count() == 5


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (None,)], "v double")

    def filled(strategy, **options):
        out = prep.impute(df, prep.fit_impute(df, ["v"], strategy, **options))
        return sorted(r["v"] for r in out.collect())

    assert filled("mean") == [1.0, 1.0, 2.0, 4.0]
    assert filled("median") == filled("mode") == [1.0, 1.0, 1.0, 4.0]
    assert filled("constant") == [-999.0, 1.0, 1.0, 4.0]
    with pytest.raises(ValueError):
        prep.fit_impute(df, ["v"], "nonsense")


def test_one_hot_unknown_and_width_limit(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    found = prep.fit_categories(df, ["c"])
    other = spark.createDataFrame([("z",), (None,)], "c string")
    assert [tuple(r) for r in prep.one_hot_columns(other, found).collect()] == [(0.0, 0.0), (0.0, 0.0)]
    with pytest.raises(ValueError):
        prep.fit_categories(df, ["c"], most=1)


def test_zip_submission_is_refused(spark, sample, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_submission(sample, str(tmp_path / "s"), "id", "target", compression="zip")


def test_submission_format(spark, sample, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_submission(sample, path, "id", "target", "%.3f", index=True)
    out = spark.read.option("header", "true").csv(path)
    assert out.columns == ["index", "id", "target"]
    assert {r["target"] for r in out.collect()} == {"0.000", "1.000"}
