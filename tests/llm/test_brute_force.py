"""Each operator against a brute-force version, on awkward rows and on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from foldwright.llm import boost, html, licenses, mixing, near, nearest, pack, repeats, rules, secrets
from foldwright.llm.catalog import QUERIES, TOKENIZER, TWINS
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, id string, kept int"


def _prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(n))


def _rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, copies, near copies, repeated rows and names that operators use."""
    base, other = _prose(1, 400), _prose(2, 300)
    edited = " ".join(w if i % 60 else w + "x" for i, w in enumerate(base.split()))
    far = " ".join(w if i % 12 else w + "y" for i, w in enumerate(base.split()))
    texts = [
        None, "", "   \n\t ", "one", "one two", "One TWO", base, base, edited, far, other, base + "\n" + other, other[:-3],
        _prose(3, 30_000), "ab " * 900, "é" * 700 + " ñandú \x1c x\x85y  z", "same line here\n" * 60, _prose(4, 60) + "\n\n" + _prose(4, 60), "<|endoftext|> it's ½ ǅ",
    ]
    rows = [(i + 1, t, None, None if i % 5 == 0 else f"s{i % 3}", i, i, "k", "x", 1) for i, t in enumerate(texts)]
    return [*rows, (None, base, "en", "s1", None, None, None, None, None), (8, base, "en", "s1", 3, 3, "k", "x", 1), (40, base, None, None, 0, 0, "", "", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def _shingles(text: str | None) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _components(sets: list[tuple[int, frozenset]]) -> dict[int, int]:
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            shared = len(a & b)
            if a and b and 100 * shared >= 85 * (len(a) + len(b) - shared):
                x, y = top(i), top(j)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in sets}


def test_near_duplicates(docs, empty, small):
    for table in (docs, small):
        rows = table.select("doc_id", "text").collect()
        wanted = _components([(r.doc_id, _shingles(r.text)) for r in rows if r.doc_id is not None])
        found = near.near_duplicates(table).collect()
        assert len(found) == len(rows)
        assert {(r.id, r.component_id) for r in found if r.id is not None} == set(wanted.items())
        assert sorted((r.id or 0, r.n_shingles) for r in found) == sorted((r.doc_id or 0, len(_shingles(r.text))) for r in rows)
        assert all(r.kept == (r.id is None or r.id == r.component_id) for r in found)
    assert near.near_duplicates(empty).count() == 0


def test_near_duplicates_in_a_large_group(spark, monkeypatch):
    """A group whose members differ so that links form a web; the small limit sends it through the deeper bandings."""
    monkeypatch.setattr(near, "COLD", 8)
    base, r = _prose(5, 150).split(), random.Random(6)
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(r.randint(0, 9)):
            words[r.randrange(len(words))] = f"w{r.random()}"
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x.id: x.component_id for x in near.near_duplicates(table).collect()}
    assert found == _components([(i, _shingles(t)) for i, t in rows])


def test_near_duplicates_with_an_outsider_of_a_tight_group(spark, monkeypatch):
    """The outsider links to one member only, which is not the smallest of any bucket that both are in."""
    monkeypatch.setattr(near, "COLD", 8)
    base, r = _prose(1, 4000).split(), random.Random(1)
    places = r.sample(range(10, 3990, 10), 148)
    change = lambda at: " ".join(f"x{i}" if i in at else w for i, w in enumerate(base))
    outside, own = places[:65], places[65:]
    rows = [(i, change({p})) for i, p in enumerate(own)]
    rows += [(500, change({outside[0]})), (900, change(set(outside)))]
    sets = {i: _shingles(t) for i, t in rows}
    linked = [i for i in sets if i != 900 and 100 * len(sets[i] & sets[900]) >= 85 * len(sets[i] | sets[900])]
    assert linked == [500]
    found = {x.id: x.component_id for x in near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found.values()) == {0}


@pytest.mark.parametrize("cold", [4, 64])
def test_likely_pairs_are_all_pairs_of_shared_buckets_once(spark, monkeypatch, cold):
    """Members of labels of their own, of two labels and of many; a bucket's size decides nothing but the blocks."""
    monkeypatch.setattr(near, "COLD", cold)
    monkeypatch.setattr(near, "MINORITY", 2, raising=False)
    base, r, rows = _prose(5, 150).split(), random.Random(8), []
    for i in range(60):
        words = list(base)
        for _ in range(r.randint(1, 6)):
            words[r.randrange(len(words))] = f"w{r.random()}"
        rows.append((i, " ".join(words)))
    signed = near.signatures(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").cache()
    digests = F.transform("keys", lambda k: (k.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int"))
    marks = signed.select("id", "places", "n_shingles", digests.alias("digests"))
    known = {x.id: x for x in signed.collect()}
    for labels in (60, 2, 9):
        label = (F.col("id") % labels).alias("label")
        found = near._likely(signed.select(F.explode("keys").alias("key"), "id", label), marks, 85)
        got = sorted((x.a, x.b) for x in found.collect())
        wanted = []
        for a, b in itertools.combinations(sorted(known), 2):
            one, two = (np.frombuffer(known[i].places, np.uint8) for i in (a, b))
            sizes = (np.array([known[i].n_shingles]) for i in (a, b))
            if a % labels != b % labels and set(known[a]["keys"]) & set(known[b]["keys"]) and near._enough((one == two).sum(keepdims=True), *sizes, 192, 85)[0]:
                wanted.append((a, b))
        assert len(wanted) > 100
        assert got == wanted


def test_super_min_hash_estimates_and_is_a_permutation():
    r = np.random.default_rng(1)
    shared, a, b = r.integers(1, 1 << 60, 300), r.integers(1, 1 << 60, 50), r.integers(1, 1 << 60, 50)
    sets = [np.unique(np.concatenate(x)).astype(np.uint64) for x in ((shared, a), (shared, b), (shared[:1],))]
    out = near.super_min_hash(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), 192)
    assert abs((out[0] == out[1]).mean() - 300 / 400) < 0.12
    assert sorted(out[2] >> np.uint64(32)) == list(range(192))  # one element offers every rank once


def _repeats(rows: list[tuple], length: int) -> list[tuple]:
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(x[i : i + length] for _, x in raw for i in range(len(x) - length + 1))
    out = []
    for doc, x in raw:
        gone, spans, last = bytearray(len(x)), 0, -1
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                spans += i > last
                last = i + length
                gone[i:last] = b"\1" * length
        left = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        out.append((doc, len(x), len(x) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, trigger", [(400, 100), (40, 10)])
def test_repeats(docs, empty, length, trigger):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = repeats.remove_repeats(docs, length=length, trigger=trigger, keep_text=True).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == _repeats(rows, length)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)
    assert repeats.remove_repeats(empty, length=length, trigger=trigger).count() == 0


def test_repeats_on_the_small_table(small):
    found = sorted((tuple(r) for r in repeats.remove_repeats(small).collect()), key=str)
    assert found == _repeats([(r.doc_id, r.text) for r in small.collect()], 400)


@pytest.mark.parametrize("name", ["CONTEXTS", "NAMED_ROWS"])
def test_repeats_beyond_the_limits(docs, small, monkeypatch, name):
    monkeypatch.setattr(repeats, name, 0)
    for table in (docs, small):
        found = sorted((tuple(r) for r in repeats.remove_repeats(table).collect()), key=str)
        assert found == _repeats([(r.doc_id, r.text) for r in table.collect()], 400)


def test_suffix_array_is_in_byte_order():
    r = np.random.default_rng(2)
    phrases = [bytes(r.integers(97, 99, n).astype(np.uint8)) for n in (40, 12, 13, 60)]
    order, same = repeats.suffix_array(phrases, 12)
    strings = [p[i : i + 12] for p in phrases for i in range(len(p) - 11)]
    assert sorted(order) == list(range(len(strings))) and [strings[i] for i in order] == sorted(strings)
    assert same == [k > 0 and strings[order[k]] == strings[order[k - 1]] for k in range(len(order))]
    assert repeats.suffix_array([], 12) == ([], [False])


def test_repeats_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STEP", 5000)
    text = _prose(7, 4000)
    rows = [(1, text + text[3000:9000]), (2, "x" * 50 + text[100:1500]), (3, "ab" * 3000)]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in found), key=str) == _repeats(rows, 400)


def _counts(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, docs, empty, small):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    none = spark.createDataFrame([], labels.schema)
    for table, marks in ((docs, labels), (small, labels), (docs, none)):
        found = rules.judge(table, marks).collect()
        wanted = sorted(((r.doc_id, *_counts(r.text)) for r in table.collect()), key=str)
        assert sorted((tuple(r)[:6] for r in found), key=str) == wanted
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in found)
        kept = rules.keep_good(table, marks)
        assert kept.schema == table.schema
        assert sorted((r.doc_id or 0) for r in kept.collect()) == sorted((r.id or 0) for r in found if r.kept)
    assert rules.judge(empty, labels).count() == 0


def test_decision_list_learns_conjunctions():
    r = np.random.default_rng(3)
    table = {c: r.random(6000) for c in "abc"}
    bad = ((table["a"] > 0.7) & (table["b"] <= 0.4)) | (table["c"] > 0.9)
    found = rules.learn(table, bad, list("abc"))
    said = np.zeros(6000, bool)
    for rule in found:
        said |= rules._covers(rule, table, 6000)
    assert (said == bad).mean() > 0.97
    assert {c.column for rule in found for c in rule} == set("abc")


def test_mix(spark, docs, empty, small):
    for table in (docs, small):
        found = mixing.mix(table).collect()
        assert len(found) == table.count()
        assert all(r.size == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 2 * r.size for r in found)
        by = collections.defaultdict(lambda: [0, 0, 0.0])
        for r in found:
            by[r.source][0] += r.size
            by[r.source][1] += r.taken
            by[r.source][2] = r.target
            assert by[r.source][2] == r.target
        sizes = {s: x[0] for s, x in by.items()}
        weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [3, 1, 2] * len(sizes), strict=False))
        left, targets = dict(sizes), {}
        budget = 1.5 * sum(sizes.values())
        while True:  # share, stop what is above, share again
            rest, all_weights = budget - sum(targets.values()), sum(weights[s] for s in left)
            over = [s for s in left if weights[s] * rest / all_weights >= 2 * sizes[s]]
            if not over:
                break
            targets |= {s: 2.0 * left.pop(s) for s in over}
        targets |= {s: weights[s] * rest / all_weights for s in left}
        for s, (size, taken, target) in by.items():
            assert size == sizes[s] and target == pytest.approx(targets[s])
            assert abs(taken - target) <= 3
        assert sorted(map(str, mixing.mix(table.repartition(3)).collect())) == sorted(map(str, found))
        copies = mixing.mixed_documents(table)
        assert copies.columns == table.columns
        assert sum(len(WORD.findall(r.text)) for r in copies.collect()) == sum(r.taken for r in found)
    assert mixing.mix(empty).count() == 0
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert sorted(con.execute(TWINS["op3_mix_sources"]).fetchall()) == sorted(map(tuple, QUERIES["op3_mix_sources"](spark, SMALL).collect()))


def test_nearest(spark):
    r = np.random.default_rng(5)
    centres = r.standard_normal((30, 16))
    vectors = centres[r.integers(0, 30, 3000)] + 0.4 * r.standard_normal((3000, 16))
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows[7], rows[20], rows[41] = (7, None, 1), (20, [0.0] * 16, 1), (41, [float("nan")] + [1.0] * 15, 1)
    rows += [(None, rows[1][1], 1), (60, [1.0, 2.0], 1), (61, [1.0, None], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = nearest.nearest(table, "vec_id", "embedding", every=20, k=20).collect()
    used = np.array([i not in (7, 20, 41) for i in range(3000)])
    exact = vectors.astype(np.float32).astype(float)
    hits = 0
    by = collections.defaultdict(list)
    for x in found:
        by[x.query_id].append(x)
    queries = [i for i in range(0, 3000, 20) if i != 20]
    assert set(by) == set(queries)
    for i in queries:
        score = np.where(used, exact @ exact[i], -np.inf)
        score[i] = -np.inf
        top = np.lexsort((np.arange(3000), -score))[:20]
        mine = sorted(by[i], key=lambda x: x.rank)
        assert [x.rank for x in mine] == list(range(1, 21))
        assert [(-x.score, x.id) for x in mine] == sorted((-x.score, x.id) for x in mine)
        assert all(x.score == pytest.approx(score[x.id], abs=1e-12) for x in mine)
        hits += len(set(top) & {x.id for x in mine})
    assert hits / (20 * len(queries)) >= 0.9
    few = nearest.nearest(table.filter("vec_id < 6"), "vec_id", "embedding", every=5, k=20).collect()
    assert collections.Counter(x.query_id for x in few) == {0: 5, 5: 5}
    assert nearest.nearest(table.limit(0), "vec_id", "embedding", every=20, k=20).count() == 0


@pytest.mark.parametrize("rows", [700, 66_000])
def test_collisions_by_ranks_and_by_places_are_the_same(rows, monkeypatch):
    """Counting by ranks, by places or by either of them gives the same rows, also beyond two bytes of rank."""
    r = np.random.default_rng(6)
    vectors = r.standard_normal((rows, 8))
    index = nearest.CollisionIndex(vectors, float(np.sqrt((vectors**2).sum(axis=1).max())), 12, 7)
    low, high = r.integers(0, rows // 2, 12), r.integers(rows // 2, rows + 1, 12)
    low[0], high[0], low[1], high[1] = 0, rows, 5, 5
    want = np.bincount(np.concatenate([index.order[j, low[j] : high[j]] for j in range(12)]), minlength=rows)
    assert (index.collisions(low, high) == want).all()
    for query in (0, 1, 2):
        found = []
        for sparse in (0, 16, float("inf")):
            monkeypatch.setattr(nearest, "SPARSE", sparse)
            found.append(index.search(vectors[query], np.array([query]), 5, 1.12, 0.618))
        for rows_found, scores in found[1:]:
            assert (rows_found == found[0][0]).all() and (scores == found[0][1]).all()


def test_nearest_over_blocks(spark, monkeypatch):
    """Many blocks and several indexes a block find what one index finds, up to the recall; batches may cut a block."""
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 150)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 10)
    r = np.random.default_rng(8)
    vectors = (r.standard_normal((12, 8))[r.integers(0, 12, 900)] + 0.3 * r.standard_normal((900, 8))).round(3)
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        found = nearest.nearest(table, "vec_id", "embedding", every=20, k=10).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert collections.Counter(x.query_id for x in found) == dict.fromkeys(range(0, 900, 20), 10)
    hits = 0
    for i in range(0, 900, 20):
        score = vectors @ vectors[i]
        score[i] = -np.inf
        hits += len(set(np.lexsort((np.arange(900), -score))[:10]) & {x.id for x in found if x.query_id == i})
    assert hits / len(found) >= 0.9


def test_secrets(spark, docs, empty):
    key = "AKIA" + "Q" * 16
    cases = {
        "": "", f"{key} and AKIAQ": "access:0:20", "PassWord = 'abcdefghijkl'": "assign:0:24", "token=short": "", "token=secret:abcdefghijklmnop": "",
        "0123456789abcdef0123 abc": "hex:0:20", "ſecret=abcdefghijklmnop": "", "user=bob1 pwd=hunter22 at https://x.example/y": "weak_id:0:9,weak_secret:10:22,endpoint:26:45",
        "pwd=hunter22": "", "pwd=hunter22\n\nuser=bob1": "weak_secret:0:12,weak_id:14:23", "a pwd=hunter22\n\nuser=bob1": "", "pwd=hunter22\n\nsays user=bob1": "",
        "user=bob1 " + "x" * 600 + " pwd=hunter22": "weak_id:0:9,weak_secret:611:623", f"pwd=hunter22 {key}": "weak_secret:0:12,access:13:33",
    }
    table = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    found = {r.id: r for r in secrets.find_secrets(table).collect()}
    for i, (text, wanted) in enumerate(cases.items()):
        assert found[i].spans == wanted, text
        base = ",".join(x for x in wanted.split(",") if x.split(":")[0] in secrets.KINDS)
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    masked = secrets.mask_secrets(docs)
    assert masked.schema == docs.schema and masked.exceptAll(docs).count() == 0
    assert secrets.mask(f"é {key} x") == "é [SECRET] x"
    assert secrets.find_secrets(docs).count() == docs.count()
    assert secrets.find_secrets(empty).count() == 0


def test_linking_equals_all_pairs():
    """The sweep by running ends finds what comparing all parts of a scope finds."""
    r = random.Random(9)
    parts = ["user=abc1", "pwd=hunter22", "https://h.example/p", "AKIA" + "Z" * 16, "f" * 20, "\n\n", _prose(1, 40), _prose(2, 90)]
    for _ in range(200):
        text = " ".join(r.choice(parts) for _ in range(r.randint(1, 14)))
        base = secrets.base_spans(text)
        weak = [(m.start(), m.end(), k) for k, p in (("weak_id", secrets.WEAK_NAMES), ("weak_secret", secrets.WEAK_SECRETS), ("endpoint", secrets.ENDPOINTS)) for m in p.finditer(text)]
        every = base + weak
        line = re.compile(r"\s*[\w.]+\s*[:=]\s*\S.*")
        blank = [m for m in re.finditer(r"\n[ \t\r]*\n", text) if not (line.fullmatch(text[: m.start()].split("\n")[-1]) and line.fullmatch(text[m.end() :].split("\n")[0]))]
        scope = lambda s: sum(m.start() < s[0] + 1 for m in blank)  # noqa: B023, E731
        meets = lambda s, role: any(secrets.ROLE[o[2]] == role and scope(o) == scope(s) for o in every)
        wanted = sorted(s for s in weak if all(any(meets(s, role) for role in group) for group in secrets.NEEDS[s[2]]))
        assert sorted(secrets.linked_spans(text, base)) == wanted


def test_html(spark):
    article = "<article><h1>A&amp;B</h1><p>one&nbsp; two <b>bold</b><br>three<p>four<ul><li>x<li>y</ul><div class='share-bar'>no</div></article>"
    page = f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><nav>n</nav><div class=ad>a</div><!-- <p>c</p> -->{article}<footer>f</footer><script>var x='</p>';</script>"
    wanted = "A&B\n\none two bold three\n\nfour\n\nx\n\ny"
    assert html.extract(page) == wanted
    bare = "<html><body><div class='top-box'><p>Welcome to the site</p></div><div class='body-box'><p>{}</p><p>{}</p></div></body></html>"
    rows = [(i, f"http://s.example/{i}", bare.format(_prose(i, 20), _prose(i + 100, 9)), 0) for i in range(20)]
    rows += [(100, None, page, 1), (101, "odd", None, 1), (102, "http://s.example/x", "", 1), (103, "http://o.example", "plain < text", 1), (None, "http://o.example", page, 1)]
    found = {r.id: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()}
    for i in range(20):
        assert found[i].text == f"{_prose(i, 20)}\n\n{_prose(i + 100, 9)}"  # the repeated branch of the site is cut
    assert found[100].text == found[None].text == wanted and found[101].text == found[102].text == "" and found[103].text == "plain < text"
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_html_where_only_the_tree_decides(spark):
    """Boilerplate inside articles, teasers beside an undeclared article, small hosts of one domain, copies of one page."""
    box = "<div class='join-us'><h3>Join</h3><p>Get our letters</p></div>"
    inside = "<html><body><article><h1>{}</h1><h2>Summary</h2><p>{}</p>" + box + "<p>Read more on this site</p></article></body></html>"
    cards = "<html><body><div class='wrap'><div class='story'><p>{}</p><p>{}</p></div>" + "".join(f"<article class='card'><p>{_prose(k, 6)}</p></article>" for k in (900, 901)) + "</div></body></html>"
    rows, wanted = [], {}
    for i in range(20):
        one, two = _prose(i, 4), _prose(i + 100, 60)
        for k, url, page, text in (
            (0, f"http://a.example/{i}", inside.format(one, two), f"{one}\n\nSummary\n\n{two}"),
            (1, f"http://n{i}.b.example/", inside.format(one, two), f"{one}\n\nSummary\n\n{two}"),
            (2, f"http://c{i}.example/", cards.format(two, two[:50]), f"{two}\n\n{two[:50]}"),
            (3, "http://d.example/", inside.format("t", "x"), "t\n\nSummary\n\nx\n\nJoin\n\nGet our letters\n\nRead more on this site"),
        ):
            rows.append((4 * i + k, url, page))
            wanted[4 * i + k] = text
    found = {r.id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: t for i, t in found.items() if i % 4 != 3} == {i: t for i, t in wanted.items() if i % 4 != 3}
    assert all("x" in found[i] for i in found if i % 4 == 3)  # copies hold nothing unique, and nothing is lost
    assert found[3] == wanted[3]


def test_html_names_of_furniture_words_alone(spark):
    """Inside an article a name cuts only if all its words are those of furniture."""
    text = "Seven herons stood in the shallow water all morning."
    keeps = ['class="menu-design"', 'class="modal-verbs"', 'class="promo-code-study"', 'id="comments-on-x"', 'class="ad-hoc"']
    cuts = ['class="ad-slot-2"', 'class="comments"', 'id="comment-list"', 'class="cookie-banner"', 'class="lead newsletter-box"']
    for name, want in [*((x, text) for x in keeps), *((x, "") for x in cuts)]:
        assert html.extract(f"<main><div {name}><p>{text}</p></div></main>") == want, name
        assert html.extract(f"<div {name}><p>{text}</p></div>") == ""


def test_html_of_a_large_site(spark, monkeypatch):
    """Pages of hosts beyond the limit are dealt out and read as before; an empty table gives an empty result."""
    body = "<body><div class='x'>Read our other pages</div><article><p>Words of page {i}, read once.</p></article></body>"
    rows = [(i, "https://a.example/x" if i % 3 else None, f"<html>{body.format(i=i)}</html>") for i in range(60)]
    pages = spark.createDataFrame([*rows, rows[1]], "page_id long, url string, html string")
    plain = sorted(map(str, html.main_text(pages).collect()))
    monkeypatch.setattr(html, "HOT_PAGES", 5)
    assert sorted(map(str, html.main_text(pages).collect())) == plain and len(plain) == 61
    assert html.main_text(pages.limit(0)).count() == 0


def test_html_names_inside_an_article(spark):
    """Loose words in names cut nothing from an article unless the whole site repeats the branch."""
    open_, cut = "<header class='entry-header'><h1>{}</h1></header><section id='related-work'><p>{}</p></section><div class='social-history'>{}</div><section id='search'><p>{}</p></section><p class='notice'>{}</p>", "<div class='share-bar'>no</div><div class='newsletter'>no</div><div class='social-share'>no</div>"
    texts = lambda i: [_prose(10 * i + k, 12) for k in range(5)]
    page = lambda i, more: f"<html><body><article>{open_.format(*texts(i))}{cut}{more}</article><div class='related'>no</div></body></html>"
    assert html.extract(page(1, "")) == "\n\n".join(texts(1))
    same = "<section id='related'><p>Our best stories</p></section><div class='widget'>Weather today</div>"
    rows = [(i, f"http://s.example/{i}", page(i, same)) for i in range(10)]
    rows.append((50, None, page(50, same)))
    found = {r.id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == "\n\n".join(texts(i)) for i in range(10))
    assert found[50] == "\n\n".join([*texts(50), "Our best stories", "Weather today"])


def test_pack(docs, empty, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    for table in (docs.filter("doc_id is not null and doc_id <> 8 or lang is null"), small):
        found = pack.pack(table, TOKENIZER).collect()
        by, sequences = collections.defaultdict(list), collections.defaultdict(list)
        for r in found:
            by[r.id].append(r)
            sequences[r.sequence_id].append(r)
        for row in table.collect():
            ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [1]
            at = 0
            for r in sorted(by[row.doc_id], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
                at += r.length
            assert at == len(ids)
        for rows in sequences.values():
            at = 0
            for r in sorted(rows, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= 2048
    assert pack.pack(empty, TOKENIZER).count() == 0
    assert sum(r.length for r in pack.pack(docs, TOKENIZER).collect()) == sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())


def test_pack_reads_texts_in_small_batches(spark, monkeypatch):
    """A batch of ten thousand texts fills an executor and its workers; pieces here have their batch's rows as length."""
    import pyarrow as pa

    def sizes(docs, *_):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                yield pa.RecordBatch.from_pydict({"id": [0], "start": [0], "length": [n], "ids_crc32": [0], "doc_tokens": [n]}, pa.schema([(c, pa.int64()) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")]))

        return docs.mapInArrow(run, "id long, start long, length long, ids_crc32 long, doc_tokens long")

    monkeypatch.setattr(pack, "token_pieces", sizes)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 2500, 1, 1).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    assert sorted(r["length"] for r in pack.pack(docs, TOKENIZER, capacity=4096).collect()) == [500, 1000, 1000]
    assert spark.conf.get(name) == before


def test_fill_is_the_best_filling():
    r = random.Random(4)
    for _ in range(200):
        counts = {r.randint(1, 30): r.randint(1, 3) for _ in range(5)}
        room = r.randint(1, 60)
        sums = {0}
        for k, v in counts.items():
            sums = {s + k * i for s in sums for i in range(v + 1)}
        chosen = pack.fill(counts, room)
        assert sum(k * v for k, v in chosen.items()) == max(s for s in sums if s <= room)
        assert all(v <= counts[k] for k, v in chosen.items())


def test_classifier(spark, docs, empty):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    found = boost.score_quality(table, labels, rounds=40).collect()
    assert len(found) == table.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in found)
    tested = [(r.predicted, known[r.id]) for r in found if r.held_out and r.id in known]
    assert np.mean([a == b for a, b in tested]) > 0.95
    assert boost.score_quality(docs, labels.limit(0)).count() == docs.count()
    assert boost.score_quality(empty, labels).count() == 0


def test_trees_match_a_walk():
    r = np.random.default_rng(2)
    x = r.random((500, 4))
    model = boost.train(x, (x[:, 0] + x[:, 1] > 1).astype(float), rounds=20, depth=3)
    for row, margin in zip(x[:50], model.margin(x[:50]), strict=True):
        total = model.start
        for f, c, v in zip(model.feature, model.limit, model.value, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > c[node])
            total += v[node - len(f)]
        assert total == pytest.approx(margin)
    assert ((model.score(x) > 0.5) == (x[:, 0] + x[:, 1] > 1)).mean() > 0.93


def test_licenses(spark, docs, empty):
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    pairs = lambda t: set(zip(words(t), words(t)[1:], strict=False))

    def best(unit: str) -> float:
        a = pairs(unit)
        return max((2 * len(a & b) / (len(a) + len(b)) for b in (pairs(t) for _, t in licenses.TEMPLATES) if a), default=0.0)

    known = licenses.Templates(licenses.TEMPLATES, 0.8)
    r = random.Random(8)
    for name, text in licenses.TEMPLATES:
        for drop in (0, 1, 2, 4):
            w = text.split()
            for _ in range(drop):
                w[r.randrange(len(w))] = r.choice(["", "foo bar", "the"])
            unit, wanted = " ".join(w), best(" ".join(w))
            found = licenses.matches(unit, known)
            assert bool(found) == (wanted >= 0.8) and (not found or found[0][3] == pytest.approx(wanted))
            assert drop or name == found[0][2]
    lines = spark.createDataFrame([(1, f"{_prose(1, 30)}\nReleased under the MIT License.\n{_prose(2, 9)}")], "doc_id long, text string")
    row = licenses.find_licenses(lines).first()
    assert (row.n_matches, row.license, row.score) == (1, "MIT", 1.0)
    assert licenses.find_licenses(docs).count() == docs.count() and licenses.find_licenses(empty).count() == 0


def test_licenses_wrapped_and_embedded(spark):
    """Notices over several lines, in a line of other prose and in full, inside longer documents."""
    whole = {n: max((t for m, t in licenses.TEMPLATES if m == n), key=len) for n in ("MIT", "Apache-2.0", "GPL-3.0", "BSD-2-Clause", "BSD-3-Clause")}
    apache = next(t for n, t in licenses.TEMPLATES if n == "Apache-2.0" and "Unless" in t)
    cases = [(n, "# " + "\n# ".join(re.findall(r".{1,60}(?:\s|$)", " ".join(t.split())))) for n, t in [*whole.items(), ("Apache-2.0", apache)]]
    cases += [("MIT", "Released under the MIT License."), ("CC-BY-NC-4.0", "licensed under\nCC BY-NC 4.0"), ("GPL-2.0", "This work is licensed under the GNU\nGeneral Public License, version 2.")]
    rows = [(i, f"{_prose(i, 2500)}\n\n{_prose(i, 5)} {t} {_prose(i + 50, 2500)}") for i, (_, t) in enumerate(cases)]
    rows.append((len(cases), "Released under the MIT License.\n" * 3000))
    found = {r.id: r for r in licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (name, notice) in enumerate(cases):
        assert found[i].license == name and found[i].score > 0.97, name
        start, end = map(int, max(found[i].spans.split(","), key=lambda s: int(s.split(":")[2]) - int(s.split(":")[1])).split(":")[1:])
        assert re.findall(r"\w+", rows[i][1][start:end]) == re.findall(r"\w+", notice)
    assert found[len(cases)].license == "MIT" and found[len(cases)].n_matches == 3000 + 1


def test_windows_are_the_best_of_all():
    known = licenses.Templates([("A", "a b c d e f"), ("B", "a b x d e g h")], 0.7)
    r = random.Random(3)
    for _ in range(300):
        words = [r.choice("abcdefghx") for _ in range(r.randint(2, 30))]
        for _ in range(r.randint(0, 2)):
            words[(k := r.randrange(len(words))) : k] = list("abcdef")[r.randint(0, 1) :]
        every = [frozenset(zip(words[i:j], words[i + 1 : j], strict=False)) for i in range(len(words)) for j in range(i + 2, len(words) + 1)]
        wanted = max((2 * len(p & t) / (len(p) + size) for p in every for size, _, _, t in known.rows), default=0)
        found = licenses.windows(" ".join(words), known, known.held(words))
        assert bool(found) == (wanted >= 0.7) and (not found or max(w[3] for w in found) == pytest.approx(wanted))
    assert licenses.found_in("", known) == []


def test_pipeline(spark, small):
    """Each stage does on its own input what its operator says, with the columns of documents."""
    table = small
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, SMALL).persist()
        if name == "quality rules":
            good = {r.id for r in rules.judge(table, spark.read.parquet(f"{SMALL}/labels.parquet")).collect() if r.kept}
            assert {r.doc_id for r in out.collect()} == good
        elif name == "near-duplicates":
            rows = table.collect()
            wanted = _components([(r.doc_id, _shingles(r.text)) for r in rows])
            assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, c in wanted.items() if i == c)
        elif name == "secret scan":
            assert {r.doc_id: r.text for r in out.collect()} == {r.doc_id: secrets.mask(r.text) for r in table.collect()}
        elif name == "mixing":
            assert sum(len(WORD.findall(r.text)) for r in out.collect()) == sum(r.taken for r in mixing.mix(table).collect())
        if name != "packing":
            assert out.columns == small.columns
        table = out
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(table.columns)
    assert corpus_pipeline.run(spark, SMALL).count() == table.count()


def test_pipeline_on_awkward_rows(spark, docs, empty, tmp_path_factory):
    """Nulls, repeated ids and rows, and columns named as operators name theirs, through every stage; then no rows at all."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    names = ["whole", "cut_key", "row", "copy", "__gone", "s", "taken", "component_id", "name", "label", "n_words"]
    wide = docs.withColumns({n: F.lit(-7) for n in names})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, folder).persist()
        assert out.count() > 0
        if name != "packing":
            assert out.columns == wide.columns
            assert {r[n] for r in out.select(*names).collect() for n in names} == {-7}
        assert stage(spark, empty, folder).count() == 0
        if name == "near-duplicates":
            left = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
            rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0))
            groups = _components(list(enumerate(_shingles(t) for _, t in rows)))
            assert left == sorted((rows[i] for i, c in groups.items() if i == c), key=str)


def test_repeats_of_rows_without_ids(spark):
    """Texts without an id are told apart by more than 32 bits of hash."""
    shared = _prose(31, 120)
    one, two = _prose(32, 140), _prose(33, 140)
    made = spark.range(150_000).select(F.concat(F.lit(one), F.col("id").cast("string")).alias("t"))
    pair = made.groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("x")).filter("size(x) > 1").first()
    assert pair is not None
    a, b = pair["x"][:2]
    rows = [(None, a + shared), (None, two), (3, shared + "q"), (0, two[:700])]
    for table in (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(None, a), (None, b)], "doc_id long, text string")):
        found = sorted(tuple(r) for r in repeats.remove_repeats(table).select("n_bytes", "n_removed", "n_spans").collect())
        assert found == sorted(_removed([r.text for r in table.collect()]))


def _removed(rows: list[str]) -> list[tuple[int, int, int]]:
    data = [t.encode() for t in rows]
    count = collections.Counter(t[i : i + 400] for t in data for i in range(len(t) - 399))
    out = []
    for t in data:
        gone = [False] * (len(t) + 1)
        for i in range(len(t) - 399):
            if count[t[i : i + 400]] > 1:
                gone[i : i + 400] = [True] * 400
        gone[len(t)] = False
        out.append((len(t), sum(gone), sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))))
    return out


def test_learning_sample_is_taken_after_the_join(spark):
    """Labels of other documents cost no place, and an id counts once however often it is repeated."""
    from foldwright.llm.stats import labelled_sample

    table = spark.createDataFrame([(1 if i < 500 else i, f"w{i} " * 60) for i in range(520)] + [(None, "x")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(-4000, 520) if i != 0], "doc_id long, quality int")
    rows = labelled_sample(table, marks, "doc_id", "text", "doc_id", "quality", 20)
    assert len(rows) == 20 and rows["id"].is_unique and set(rows["id"]) <= {1, *range(500, 520)}
    assert set(labelled_sample(table, marks, "doc_id", "text", "doc_id", "quality", 100)["id"]) == {1, *range(500, 520)}
