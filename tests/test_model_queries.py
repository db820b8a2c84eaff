"""Model queries without a twin: what SQL can say of their rows, in a session that holds an observation."""

from __future__ import annotations

import pathlib
import tempfile

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as entry
from foldwright.catalog import models
from foldwright.operators import pseudo, splits
from tests.conftest import SMALL
from tests.test_models import data, logistic  # noqa: F401

UNLABELLED = f"'{SMALL}/documents.parquet' ANTI JOIN '{SMALL}/labels.parquet' USING (doc_id)"


@pytest.fixture
def observed(spark):
    """A session after its caller observed something."""
    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 10
    return spark


def rows(session, name):
    return [r.asDict() for r in entry.queries()[name](session, SMALL).collect()]


def sql(text):
    return duckdb.sql(text).fetchall()


def area(pairs):
    """AUC of ``(label, score)`` pairs, counted pair by pair."""
    pos, neg = ([s for y, s in pairs if y == k] for k in (1, 0))
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def first_score(session):
    """The validation AUC of the first round's model, from its scores of each row."""
    labelled, _ = models._documents(session, SMALL)
    parts = splits.holdout(labelled, "doc_id", "y", 0.25)
    model = models._doc_learner().fit(parts.filter("role = 'train'"))
    return area([(r["y"], r["p"]) for r in model.score(parts.filter("role = 'valid'"), "p").collect()])


def test_m15_scores_its_validation_rows(observed):
    """ordering must not write over the score that it orders by."""
    assert rows(observed, "m15_iterative_pseudo_label")[0]["score"] == pytest.approx(first_score(observed), abs=1e-6)


def test_a_round_keeps_the_score_of_its_model(data):  # noqa: F811
    train, held = (data.filter(f).select("id", "x", "z", "y") for f in ("id < 150", "id between 150 and 250"))
    _, rounds, _ = pseudo.iterate(train, data.filter("id > 250"), logistic(), "y", "id", threshold=0.8, valid=held, max_iterations=1)
    want = area([(r["y"], r["p"]) for r in logistic().fit(train).score(held, "p").collect()])
    assert want > 0.9 and rounds[0].score == pytest.approx(want, abs=1e-9)


def test_m19_scores_its_validation_rows(observed):
    """the rounds stop by this score."""
    found = rows(observed, "m19_safe_pseudo_label")
    assert found[0]["score"] == pytest.approx(first_score(observed), abs=1e-6)
    assert all(b["score"] >= a["score"] + 0.001 - 1e-6 for a, b in zip(found, found[1:]))


def test_m5_scores_every_line(observed):
    """F6"""
    (found,) = rows(observed, "m5_stack_predict")
    want = sql(f"SELECT count(*) FILTER (big), count(*) FILTER (NOT big) FROM (SELECT l_quantity * (1 - l_discount) > 25 AS big FROM '{SMALL}/lineitem.parquet')")
    assert [(found["n_pos"], found["n_neg"])] == want and found["auc"] > 0.99


def test_m28_scores_every_order(observed):
    """F7"""
    (found,) = rows(observed, "m28_adversarial_validation")
    late = "o_orderdate >= TIMESTAMP '1997-01-01'"
    want = sql(f"SELECT count(*) FILTER ({late}), count(*) FILTER (NOT {late}) FROM '{SMALL}/orders.parquet'")
    assert [(found["n_pos"], found["n_neg"])] == want and found["shifted"] == (found["auc"] > 0.5)


@pytest.fixture
def holed(tmp_path):
    """``holed(table, select)``: a folder in which ``table`` is what the select makes of it, beside the other tables."""

    def made(table, select):
        folder = pathlib.Path(tempfile.mkdtemp(dir=tmp_path))
        for path in pathlib.Path(SMALL).iterdir():
            if path.stem != table:
                (folder / path.name).symlink_to(path)
        duckdb.sql(f"COPY ({select.format(f"'{SMALL}/{table}.parquet'")}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
        return str(folder)

    return made


def test_m5_scores_lines_without_a_tax(spark, holed):
    """a null feature is no reason to fail, and no score may be NaN."""
    folder = holed("lineitem", "SELECT * REPLACE (CASE WHEN l_orderkey % 97 <> 0 THEN l_tax END AS l_tax) FROM {}")
    assert sql(f"SELECT count(*) > 0 FROM '{folder}/lineitem.parquet' WHERE l_tax IS NULL") == [(True,)]
    (found,) = [r.asDict() for r in entry.queries()["m5_stack_predict"](spark, folder).collect()]
    assert found["n_pos"] + found["n_neg"] == sql(f"SELECT count(*) FROM '{SMALL}/lineitem.parquet'")[0][0] and found["auc"] > 0.99


def test_m28_scores_orders_without_a_price(spark, holed):
    """F7"""
    folder = holed("orders", "SELECT * REPLACE (CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS o_totalprice) FROM {}")
    assert sql(f"SELECT count(*) > 0 FROM '{folder}/orders.parquet' WHERE o_totalprice IS NULL") == [(True,)]
    (found,) = [r.asDict() for r in entry.queries()["m28_adversarial_validation"](spark, folder).collect()]
    assert found["n_pos"] + found["n_neg"] == sql(f"SELECT count(*) FROM '{SMALL}/orders.parquet'")[0][0] and 0 < found["auc"] < 1


def test_missing_features_count_as_the_mean(data):  # noqa: F811
    """fitted and scored as if the mean of the rows of the fit stood there."""
    part = data.filter("id < 300")
    missing = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 7 == 1, float("nan")).when(F.col("id") % 7 == 2, float("inf")).otherwise(F.col("x"))
    mean = part.filter("id % 7 > 2").agg(F.avg("x")).first()[0]
    holes, filled = data.withColumn("x", missing), data.withColumn("x", F.when(F.col("id") % 7 <= 2, F.lit(mean)).otherwise(F.col("x")))
    got, want = ({r["id"]: r["p"] for r in logistic().fit(d.filter("id < 300")).score(d, "p").collect()} for d in (holes, filled))
    assert got == pytest.approx(want, abs=1e-9)


def labelled_part():
    """The ``(origin, n, share)`` of the labelled documents, and how many there are without a label."""
    ((n, share),) = sql(f"SELECT count(*), avg(quality) FROM '{SMALL}/documents.parquet' JOIN '{SMALL}/labels.parquet' USING (doc_id)")
    ((rest,),) = sql(f"SELECT count(*) FROM {UNLABELLED}")
    return {"origin": "train", "n": n, "share": pytest.approx(share)}, rest


def test_m14_keeps_labelled_rows_and_half_of_the_sure_ones(observed):
    """F8"""
    train, rest = labelled_part()
    found = {r["origin"]: r for r in rows(observed, "m14_pseudo_label")}
    assert found["train"] == train and 0 < found["pseudo"]["n"] <= (rest + 1) // 2


def test_m17_keeps_labelled_rows_and_half_of_the_others(observed):
    """F10"""
    train, rest = labelled_part()
    found = {r["origin"]: r for r in rows(observed, "m17_soft_pseudo_label")}
    assert found["train"] == train and found["pseudo"]["n"] == rest // 2 and 0 < found["pseudo"]["share"] < 1


def test_m18_adds_at_most_its_share_of_sure_rows(observed):
    """F11"""
    train, rest = labelled_part()
    found = rows(observed, "m18_top_pseudo_label")
    assert [r["iteration"] for r in found] == [1, 2]
    for r in found:
        assert 0 < r["n_pseudo_labels"] <= int(rest * 0.3) and r["total_size"] == train["n"] + r["n_pseudo_labels"]
        assert 0.8 <= r["mean_confidence"] <= 1


def test_m20_scores_every_labelled_row_at_each_stage(observed):
    """F13"""
    train, _ = labelled_part()
    found = sorted(rows(observed, "m20_curriculum"), key=lambda r: r["model"])
    assert [(r["model"], r["stage_size"]) for r in found] == [("stage0", train["n"] // 2), ("stage1", train["n"] // 2 * 2)]
    assert all(r["n_pos"] + r["n_neg"] == train["n"] and 0 <= r["auc"] <= 1 for r in found)


#: one labelled and one unlabelled document get no text, two others no length
HOLES = f"""SELECT * EXCLUDE (r) REPLACE (CASE WHEN r <> 1 THEN text END AS text, CASE WHEN r > 2 THEN n_chars END AS n_chars)
    FROM (SELECT d.*, row_number() OVER (PARTITION BY quality IS NULL ORDER BY doc_id) AS r
          FROM {{}} d LEFT JOIN '{SMALL}/labels.parquet' USING (doc_id))"""
EMPTY = HOLES.replace("CASE WHEN r <> 1 THEN text END", "CASE WHEN r = 1 THEN '' ELSE text END").replace("CASE WHEN r > 2 THEN n_chars END", "CASE WHEN r = 1 THEN 0 ELSE n_chars END")


def test_a_null_text_has_the_features_of_an_empty_one(spark, holed):
    """F8, F10, F11, F12, F13"""
    def features():
        return [sorted(tuple(r) for r in part.collect()) for part in models._documents(spark, folder)]

    folder = holed("documents", EMPTY)
    want = features()
    folder = holed("documents", HOLES)
    assert features() == want and all(v is not None for part in want for r in part for v in r)


@pytest.mark.parametrize("name", ["m14_pseudo_label", "m17_soft_pseudo_label", "m18_top_pseudo_label", "m19_safe_pseudo_label", "m20_curriculum"])
def test_documents_without_a_text_stay_in(spark, holed, name):
    """No failure, no NaN, and every labelled document."""
    train, rest = labelled_part()
    found = [r.asDict() for r in entry.queries()[name](spark, holed("documents", HOLES)).collect()]
    assert found and all(v == v for r in found for v in r.values())
    if name in ("m14_pseudo_label", "m17_soft_pseudo_label"):
        assert {r["origin"]: r for r in found}["train"] == train
    elif name == "m18_top_pseudo_label":
        assert all(r["total_size"] - r["n_pseudo_labels"] == train["n"] for r in found)
    elif name == "m19_safe_pseudo_label":
        assert found[0]["n_pseudo_labels"] <= rest
    else:
        assert all(r["n_pos"] + r["n_neg"] == train["n"] for r in found)
