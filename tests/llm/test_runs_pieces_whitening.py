"""Periodic runs, SentencePiece encoding and whitening against brute force, on awkward rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import types as T

from foldwright.llm import periods, pieces, texts, whiten
from foldwright.llm.catalog import PIECE_MODEL, QUERIES
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(w: list) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` by comparing every lag word by word."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def _looped(doc_id: int | None, text: str | None) -> list[str]:
    w = WORD.findall(text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def _kept(w: list, runs: list[tuple[int, int, int]]) -> list:
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    return [x for i, x in enumerate(w) if i not in gone]


def test_runs_of_random_words():
    r = random.Random(1)
    for _ in range(400):
        rows = []
        for _ in range(r.randint(1, 4)):
            kinds, n = r.choice([1, 2, 3, 5, 20, 200]), r.randint(0, r.choice([10, 30, 120, 300]))
            w = [r.randrange(kinds) for _ in range(n)]
            if r.random() < 0.5 and n > 5:
                a = r.randrange(n)
                p = 1 + r.randrange(max(1, (n - a) // 2))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            if r.random() < 0.3 and n > 5:
                w[r.randrange(n)] = 999
            rows.append(w)
        word = texts.mix(np.array(sum(rows, []), np.int64).astype(texts.U64) + texts.U64(17))
        limits = np.cumsum([0] + [len(w) for w in rows])
        found = periods.periodic(word, np.repeat(np.arange(len(rows)), np.diff(limits)))
        wanted = [(a + at, b + at, q) for w, at in zip(rows, limits, strict=False) for a, b, q in _runs(w)]
        assert [tuple(x) for x in found.tolist()] == wanted


def test_runs_of_a_fibonacci_word_and_of_one_very_long_run():
    a, b = [0], [0, 1]
    while len(b) < 800:
        a, b = b, b + a
    found = periods.periodic(texts.mix(np.array(b).astype(texts.U64)), np.zeros(len(b), int))
    assert [tuple(x) for x in found.tolist()] == _runs(b)
    long = texts.mix(np.tile(np.arange(7), 100_000).astype(texts.U64))
    assert periods.periodic(long, np.zeros(len(long), int)).tolist() == [[0, 700_000, 7]]


def test_rare_words_split_until_stable():
    # 9 and 8 stand once; without them the 5s stand alone; only the tail is left
    w = [5, 1, 2, 9, 3, 5, 1, 2, 3, 8] + [1, 2, 3] * 5
    at, segment = periods.split_rare(texts.mix(np.array(w).astype(texts.U64)), np.zeros(len(w), int))
    assert at.tolist() == list(range(10, 25)) and len(set(segment)) == 1


AWKWARD = [
    None, "", "  \n\t ", "one", "ab " * 900, "a b c " * 4 + "x " + "a b c " * 4, "  lead  and  trail \n", "same line here\n" * 60, "▁x ▁", "é" * 700 + " ñandú \x1c x\x85y  z",
    "a\0b </s> <unk> <0x41>", "漢字 𝒳 👩‍👩‍👧 é", " ".join(f"w{i % 97}" for i in range(5000)), "﻿​　 x",
]
SCHEMA = "doc_id long, text string, runs string, id string, n int, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "r", None, 1, "x") for i, t in enumerate(AWKWARD)] + [(None, AWKWARD[4], None, "i", None, None), (3, "one", "r", None, 1, "x"), (3, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def awkward_folder(docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_periodic_runs_of_texts(spark, docs):
    for row in periods.periodic_runs(docs).join(docs.select("doc_id", "text"), periods.F.col("id").eqNullSafe(periods.F.col("doc_id"))).collect():
        if row.doc_id == 3:
            continue
        w = WORD.findall(row.text or "")
        assert (row.n_words, [(r.start, r.start + r.length, r.period) for r in row.runs], row.kept_text) == (len(w), _runs(w), " ".join(_kept(w, _runs(w))))
    three = sorted((r.n_words, r.kept_text) for r in periods.periodic_runs(docs).filter("id = 3").collect())
    assert three == [(0, ""), (1, "one"), (1, "one")]
    assert periods.periodic_runs(docs.filter("false")).count() == 0


def _check_op11(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    wanted = []
    for r in table.select("doc_id", "text").collect():
        w = _looped(r.doc_id, r.text)
        runs = _runs(w)
        best = max(((b - a, -a, -q) for a, b, q in runs), default=None)
        lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
        first = (None,) * 4 if best is None else (-best[1], best[0], -best[2], 1000 * best[0] // -best[2])
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(_kept(w, runs))))
        wanted.append((r.doc_id, len(runs), *first, *digests))
    found = QUERIES["op11_periodic_runs"](spark, folder)
    assert [(f.name, f.dataType) for f in found.schema] == [("doc_id", T.LongType()), *((c, T.LongType()) for c in ("n_runs", "start", "length", "period", "exponent_milli")), ("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType())]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    return wanted


def test_op11_query(spark, awkward_folder, tmp_path):
    assert sum(x[1] > 0 for x in _check_op11(spark, awkward_folder)) >= 4
    # all but the longest texts of the smallest table, whose lags the slow comparison takes minutes for
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    documents.filter("n_chars < 9000").write.parquet(f"{tmp_path}/documents.parquet")
    assert sum(x[1] > 0 for x in _check_op11(spark, str(tmp_path))) >= 5


def test_pieces_equal_the_library(spark, awkward_folder):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for folder in (awkward_folder, SMALL):
        table = spark.read.parquet(f"{folder}/documents.parquet")
        rows = table.select("doc_id", "text").collect()
        wanted = []
        for r in rows:
            ids = own.encode(r.text or "", add_eos=True)
            digests = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), own.decode(ids)))
            size = len((r.text or "").encode())
            wanted.append((r.doc_id, len(ids), *digests, size, size))
        found = QUERIES["op12_sentencepiece"](spark, folder).collect()
        assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert pieces.encode(table.filter("false"), PIECE_MODEL).count() == 0


def test_spans_equal_the_library(spark, docs):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    found = {r.id: r for r in pieces.encode(docs.filter("doc_id <> 3"), PIECE_MODEL).collect()}
    for i, text in enumerate(AWKWARD):
        if i != 3:
            wanted = own.encode(text or "", out_type="offset_mapping", return_bytes=True)["offsets"] + [(len((text or "").encode()),) * 2]
            assert list(zip(found[i].starts, found[i].ends, strict=True)) == [tuple(x) for x in wanted]


@pytest.mark.parametrize("options", [(), ((4, 0),), ((3, 0),), ((5, 0),), ((3, 0), (4, 0), (5, 0))])
def test_normaliser_with_a_compiled_map(options):
    """Longest prefixes, dropped and doubled characters, blanks: text and alignment as the library gives them."""
    raw = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    body = b"".join(bytes([field << 3, value]) for field, value in options)
    raw += bytes([3 << 3 | 2, len(body)]) + body if body else b""
    wanted, own = sentencepiece.SentencePieceNormalizer(model_proto=raw), pieces.Normaliser(raw)
    r = random.Random(2)
    letters = [*" aA　ＡＢ①ﬁ½é\t\n…¨\x07Ⅷ▁​\xa0㌔", "é", "ｶﾞ", "가", "한"]
    for _ in range(1500):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14))).encode()
        normal, origin = wanted.Normalize(text, with_offsets=True)
        found, places = own(text)
        assert found == normal
        assert not normal or places.tolist() == list(origin)


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, id string")


def _check_whitening(found, rows, d):
    kept = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) == d and None not in v and np.isfinite(np.array(v, float)).all()]
    x = np.array([np.floor(1024 * v) for _, v in kept]).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(found) == n * min(8, d)
    assert sorted(((r.id, r.deviation) for r in found if r.component == 1), key=str) == sorted(((i, int(((n * v - sums) ** 2).sum())) for (i, _), v in zip(kept, x, strict=True)), key=str)
    by = {}
    for r in found:
        by.setdefault((r.id, r.deviation), {})[r.component] = r
    assert {r.n for r in found} == {n}
    for c in range(min(8, d)):
        assert abs(found[0].explained - values[found[0].component - 1] / values.sum()) < 1e-12
        if values[c] > 1e-9:
            white = centred @ axes[:, c] / np.sqrt(values[c])
            mine = np.array([by[i, int(((n * v - sums) ** 2).sum())][c + 1].whitened for (i, _), v in zip(kept, x, strict=True)])
            assert min(np.abs(mine - white).max(), np.abs(mine + white).max()) < 1e-8
    assert all(r.identity_error < 1e-9 for r in found)


def test_whitening(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    _check_whitening(QUERIES["op13_embedding_whitening"](spark, SMALL).withColumnRenamed("vec_id", "id").collect(), rows, 64)
    r = np.random.default_rng(3)
    awkward = [(i, (r.standard_normal(5) * [1, 10, 100, 0.1, 3] + [0, 5, -7e6, 0, 1]).tolist()) for i in range(300)]
    awkward += [(1, awkward[1][1]), (None, awkward[2][1]), (400, None), (401, []), (402, [1.0, 2.0]), (403, [1.0, None, 1.0, 1.0, 1.0]), (404, [float("nan")] * 5), (405, [float("inf")] * 5)]
    found = whiten.whiten(_vectors(spark, [(*x, 7, "x") for x in awkward]).repartition(7)).collect()
    _check_whitening(found, awkward, 5)


def test_whitening_without_variance_and_without_rows(spark):
    flat = whiten.whiten(_vectors(spark, [(1, [1.0, 2.0, 3.0], 1, "x"), (2, [1.0, 5.0, 3.0], 1, "x")])).collect()
    assert sorted((r.id, r.component, r.whitened is None, round(r.explained, 9)) for r in flat) == [(i, c, c > 1, float(c == 1)) for i in (1, 2) for c in (1, 2, 3)]
    assert {abs(r.whitened) for r in flat if r.component == 1} == {1.0}
    one = whiten.whiten(_vectors(spark, [(1, [1.0, 2.0], 1, "x")])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 2
    assert whiten.whiten(_vectors(spark, [])).count() == 0
    assert whiten.whiten(_vectors(spark, [(1, None, 1, "x")])).count() == 0


def test_bit_planes_give_exact_products():
    r = np.random.default_rng(4)
    for largest in (2, 1 << 11, 1 << 30, 1 << 61):
        x = r.integers(-largest, largest, (500, 4))
        part = whiten.Scatter.empty(4)
        part.add(x[:200])
        part.add(x[200:])
        exact = x.astype(object)
        assert (part.products == exact.T @ exact).all() and (part.sums == exact.sum(axis=0)).all() and part.n == 500
        assert all(sum(v << (whiten.LIMB_BITS * k) for k, v in enumerate(whiten._limbs(int(value)))) == value for value in part.products.flat)
