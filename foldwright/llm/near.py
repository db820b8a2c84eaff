"""MinHash near-duplicates (operator 10): SuperMinHash, banding, verification, components.

Rows without words are linked with nothing. Rows with a null id come back with
a null component and are kept. Rows that repeat an id count as one node, so a
repeated row shares the component of its twin. A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.llm import texts
from foldwright.llm.graph import components
from foldwright.llm.texts import GAMMA, U64, mix, salted
from foldwright.session import stage

ROWS, BANDS = 6, 32
#: members of a bucket that one task compares, or of one block of a larger bucket
COLD = 64
#: texts signed together: permutations take some two hundred times as many bytes meanwhile
SIGNED_BYTES = 1 << 19
_MEMBER = ("id", "label", "places", "n_shingles", "digests", "major")
#: up to so many ids (8 bytes each) are named to the readers of texts, so that no text moves; more are joined by a shuffle
NAMED_ROWS = 1_000_000
#: rounds of comparing representatives, which only save comparisons of members
ROUNDS = 1


def shingles(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the limits of each text's run."""
    data = texts.LOWER[data]
    start, end, doc = texts.words(data, at)
    hashes = texts.word_hashes(data, start, end)
    n = len(at) - 1
    count = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))
    wide = texts.window_hashes(hashes, width)
    whole = doc[: len(wide)] == doc[width - 1 :] if len(wide) else np.zeros(0, bool)
    sizes = np.maximum(count - width + 1, 0)
    short = np.flatnonzero((count > 0) & (count < width))
    sizes[short] = 1
    limit = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(limit[-1], U64)
    place = np.ones(limit[-1], bool)
    for d in short:
        out[limit[d]] = texts.window_hashes(hashes[first[d] : first[d + 1]], int(count[d]))[0]
        place[limit[d]] = False
    out[place] = wide[whole]
    for a, b in zip(limit[:-1], limit[1:], strict=True):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[limit[:-1][sizes > 0]] = True
    kept = np.concatenate(([0], np.cumsum(fresh)))
    return out[fresh], kept[limit]


def super_min_hash(hashes: np.ndarray, limit: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures of many sets at once, one row each.

    Every element carries a random permutation of the ``m`` places, drawn one
    step at a time; at step ``j`` it offers ``j`` plus a random fraction to the
    place that its permutation puts there. A set is finished once every place
    holds an offer of an earlier step, since later ones cannot win. Empty sets
    keep the largest value.
    """
    n = len(limit) - 1
    signature = np.full(n * m, np.iinfo(np.uint64).max, U64)
    doc = np.repeat(np.arange(n), np.diff(limit))
    low = U64(0xFFFFFFFF)
    swaps: list[np.ndarray] = []
    for j in range(m):
        if len(hashes) == 0:
            break
        x = mix(hashes + salted(j + 1))
        swap = (U64(j) + (((x & low) * U64(m - j)) >> U64(32))).astype(np.int16)
        place = swap
        for t in range(j - 1, -1, -1):
            place = np.where(place == swaps[t], np.int16(t), place)
        np.minimum.at(signature, doc * m + place, (U64(j) << U64(32)) | (x >> U64(32)))
        swaps.append(swap)
        if j < 12 or j % 4 == 0:
            active = np.unique(doc)
            open_ = active[(signature.reshape(n, m)[active] >> U64(32)).max(axis=1) > j]
            keep = np.zeros(n, bool)
            keep[open_] = True
            keep = keep[doc]
            if not keep.all():
                hashes, doc, swaps = hashes[keep], doc[keep], [s[keep] for s in swaps]
    return signature.reshape(n, m)


def _binary(rows: np.ndarray) -> pa.Array:
    """A matrix of bytes as a binary column."""
    n, width = rows.shape
    offsets = pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)[: n + 1] if width else np.zeros(n + 1, np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(rows))])


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int = 5) -> DataFrame:
    """``(id, n_shingles, h1, h2, keys, places)``: set size, 128-bit set hash, band keys, one byte for each place."""
    m = ROWS * BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in texts.blocks(batch.column(1), SIGNED_BYTES):
                hashes, limit = shingles(data, at, width)
                n = b - a
                size = np.diff(limit)
                sums = []
                for salt in (1, 2):
                    total = np.concatenate(([U64(0)], np.cumsum(mix(hashes + salted(salt)), dtype=U64)))
                    sums.append((total[limit[1:]] - total[limit[:-1]]).view(np.int64))
                places = super_min_hash(hashes, limit, m)
                band = np.zeros((n, BANDS), U64)
                for i in range(ROWS):
                    band = band * texts.MULTIPLIER + places.reshape(n, BANDS, ROWS)[:, :, i]
                band = mix(band + np.arange(1, BANDS + 1, dtype=U64) * GAMMA).view(np.int64)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32)[: n + 1]), pa.array(band.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(size), pa.array(sums[0]), pa.array(sums[1]), keys, _binary((mix(places) & U64(255)).astype(np.uint8))],
                    names=["id", "n_shingles", "h1", "h2", "keys", "places"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, h1 long, h2 long, keys array<long>, places binary")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(id, hashes)`` of ``docs(id, text)``: the whole set as ascending 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in texts.blocks(batch.column(1)):
                hashes, limit = shingles(data, at, width)
                sets = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((limit * 8).astype(np.int32)), pa.py_buffer(hashes)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), sets], names=["id", "hashes"])

    return docs.select("id", "text").mapInArrow(run, "id long, hashes binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets have ``100 * shared >= percent * all``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), U64) for c in (left, right))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            kept = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
    joined = joined.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _named(ids: DataFrame) -> DataFrame:
    """A written table of ids, broadcast only where its counted rows allow it."""
    return F.broadcast(ids) if ids.count() <= NAMED_ROWS else ids


def _shared_buckets(keyed: DataFrame) -> DataFrame:
    """``(key, id, label, n, center, center_label)`` for keys with two ids or more; the centre is the smallest id."""
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "label")).alias("c")).filter("n > 1")
    buckets = buckets.select("key", "n", F.col("c.id").alias("center"), F.col("c.label").alias("center_label"))
    return stage(keyed.join(buckets, "key"), "buckets")


def _relabelled(member: DataFrame, names: DataFrame) -> DataFrame:
    """``member`` with the labels that ``names(id, component)`` gives to its labels."""
    names = names.select(F.col("id").alias("label"), F.col("component").alias("new"))
    columns = [c for c in member.columns if c != "label"]
    return member.join(names, "label", "left").select(*columns, F.coalesce("new", "label").alias("label"))


def _cells(member: DataFrame, salt: int) -> DataFrame:
    """``(key, label, n, rep, top)`` of buckets that hold several labels; ``top`` is the cell of the most frequent one.

    The representative of a cell differs from bucket to bucket and from salt to salt.
    """
    rep = F.min_by("id", F.xxhash64("key", "id", F.lit(salt)))
    cells = member.groupBy("key", "label").agg(F.count("*").alias("n"), rep.alias("rep"))
    keys = cells.groupBy("key").agg(F.count("*").alias("labels"), F.sum("n").alias("all"), F.max(F.struct("n", "label", "rep")).alias("top")).filter("labels > 1")
    return cells.join(keys, "key")


@lru_cache(maxsize=8)
def _limits(percent: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of unions, and for each the agreeing places of ``m`` that lie five deviations below the threshold.

    Places of a SuperMinHash signature are drawn without repetition, so their
    mean varies less than that of independent ones, the less the smaller the
    union is; the factor is the one of the published analysis.
    """
    p, place = percent / 100, np.arange(1, m, dtype=float)
    sizes = np.unique(np.round(1.1 ** np.arange(8, 130)))
    limits = []
    for u in sizes:
        with np.errstate(divide="ignore"):
            below, at, above = (np.exp(u * (np.log(place / m) + np.log((place + k) / (m - 1)))).sum() for k in (-1, 0, 1))
        factor = min(1.0, 1 - (above + below - 2 * at) * (m - 1) / (u - 1))
        limits.append(m * (p - 5 * (p * (1 - p) * factor / m) ** 0.5))
    return sizes, np.array(limits)


def _enough(agree: np.ndarray, n1: np.ndarray | int, n2: np.ndarray, m: int, percent: int) -> np.ndarray:
    """Whether sets of these sizes with so many agreeing places of ``m`` may be similar enough."""
    sizes, limits = _limits(percent, m)
    # the union at the threshold, taken as the next larger size
    union = np.searchsorted(sizes, (n1 + n2) / (1 + percent / 100)).clip(max=len(sizes) - 1)
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (agree >= limits[union])


def _agreeing(pairs: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b, x, y)`` that may be links by their signatures, with the number ``agree`` of agreeing places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.array([np.frombuffer(x, np.uint8) for x in batch.column(k).to_pylist()]) for k in (4, 5))
                agree = (left == right).sum(axis=1)
                near = pa.array(_enough(agree, batch.column(6).to_numpy(), batch.column(7).to_numpy(), left.shape[1], percent))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).filter(near) for k in range(4)), pa.array(agree.astype(np.int64)).filter(near)], names=["a", "b", "x", "y", "agree"])

    for side, end in (("left", "a"), ("right", "b")):
        pairs = pairs.join(places.select(F.col("id").alias(end), F.col("places").alias(side), F.col("n_shingles").alias(f"{side}_n")), end)
    return pairs.select("a", "b", "x", "y", "left", "right", "left_n", "right_n").mapInArrow(run, "a long, b long, x long, y long, agree long")


def _best(likely: DataFrame) -> DataFrame:
    """The best agreeing pair of every two labels."""
    return likely.groupBy("x", "y").agg(F.max(F.struct("agree", "a", "b")).alias("p")).select("p.a", "p.b", "x", "y")


def _joined_labels(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """``(id, component)`` of the labels that confirmed ``pairs(a, b, x, y)`` join; None if there are none."""
    found = verified(pairs.select("a", "b"), sets, percent)
    links = found.join(pairs, ["a", "b"]).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    links = stage(links, "links")
    return None if links.isEmpty() else components(links)


def _in_small(member: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """``(a, b, x, y, agree)``: likely pairs between the labels ``x < y`` of small buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, group in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = _members(group.values)
                yield from _pairs(own, own, percent, key)

    groups = member.join(places, "id").withColumn("major", F.lit(False)).groupBy("key").agg(F.collect_list(F.struct(*_MEMBER)).alias("members"))
    return groups.select("key", "members").mapInArrow(run, "a long, b long, x long, y long, agree long")


def _pairs(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], percent: int, key: int) -> Iterator[pa.RecordBatch]:
    """Likely pairs of two blocks of a bucket; of two members that are in both only one order counts, but for majors, which are in one.

    Members that share several buckets are a pair in that of their first common
    band. Every such bucket holds both their labels, so all of them are compared.
    """
    found = []
    id2, label2, marks2, size2, digests2, major2 = right
    own = (key & 0xFFFFFFFF) - (1 << 31)
    for id1, label1, marks1, size1, digests1, _ in zip(*left, strict=True):
        agree = (marks2 == marks1).sum(axis=1)
        j = np.flatnonzero(_enough(agree, size1, size2, marks2.shape[1], percent) & (label2 != label1) & (major2 | (id1 < id2)))
        j = j[digests1[(digests2[j] == digests1).argmax(axis=1)] == own]
        if len(j):
            first, ones = label1 < label2[j], np.ones(len(j), np.int64)
            a, b, x, y = id1 * ones, id2[j], label1 * ones, label2[j]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b), np.where(first, x, y), np.where(first, y, x), agree[j]], axis=1))
    if found:
        rows = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(5)], names=["a", "b", "x", "y", "agree"])


def _in_blocks(member: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """``(a, b, x, y, agree)``: likely pairs of large buckets between the labels ``x < y``, and their agreeing places.

    Members of any but a bucket's most frequent label meet all members of other
    labels. Both sides are dealt into blocks of about ``COLD`` members by their
    ids, and every pair of blocks has a key of its own, so no bucket is one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                yield from _pairs(*(_members(batch.column(c)[r].values) for c in (1, 2)), percent, batch.column(0)[r].as_py())

    counts = member.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
    counts = counts.agg(F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("top"))
    counts = counts.select("key", F.col("top.label").alias("top"), F.ceil(F.col("all") / COLD).alias("right"), F.ceil((F.col("all") - F.col("top.n")) / COLD).alias("left"))
    rows = member.join(places, "id").join(counts.filter("left > 0"), "key").withColumn("major", F.col("label") == F.col("top"))

    def blocks(side: DataFrame, mine: str, other: str) -> DataFrame:
        side = side.withColumn(f"{mine}_block", F.pmod(F.xxhash64("id"), F.col(mine)))
        side = side.groupBy("key", f"{mine}_block").agg(F.collect_list(F.struct(*_MEMBER)).alias(f"{mine}_members"), F.first(other).alias("others"))
        return side.select("key", f"{mine}_block", f"{mine}_members", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias(f"{other}_block"))

    pairs = blocks(rows.filter("not major"), "left", "right").join(blocks(rows, "right", "left"), ["key", "left_block", "right_block"])
    return pairs.select("key", "left_members", "right_members").mapInArrow(run, "a long, b long, x long, y long, agree long")


def _members(rows: pa.StructArray) -> tuple[np.ndarray, ...]:
    """Ids, labels, places, set sizes, digests of the band keys and the mark of the most frequent label of a block."""
    marks = np.array([np.frombuffer(x, np.uint8) for x in rows.field("places").to_pylist()])
    digests = rows.field("digests").flatten().to_numpy().reshape(-1, BANDS)
    return rows.field("id").to_numpy(), rows.field("label").to_numpy(), marks, rows.field("n_shingles").to_numpy(), digests, rows.field("major").to_numpy(zero_copy_only=False)


def _likely(member: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """Likely pairs ``(a, b, x, y, agree)`` of all buckets of ``member(key, id, label)`` between different labels.

    Small buckets are compared in one task each, larger ones block against
    block; both look at every two members of different labels, whatever the size.
    """
    sizes = member.groupBy("key", "label").agg(F.count("*").alias("m")).groupBy("key").agg(F.sum("m").alias("all"), (F.sum("m") - F.max("m")).alias("minor"))
    rows = stage(member.select("key", "id", "label").join(sizes.filter("minor > 0").select("key", "all"), "key"), "mixed")
    return _in_small(rows.filter(F.col("all") <= COLD), places, percent).union(_in_blocks(rows.filter(F.col("all") > COLD), places, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row for each row of ``docs``.

    Texts with equal shingle sets are one class, found by a 128-bit set hash.
    Class representatives fall into buckets by the bands of their SuperMinHash
    signatures. First every member of a bucket is compared with the bucket's
    smallest id, which joins most of a group by as many comparisons as it has
    members. Then, where a bucket still holds several components, one member of
    each is compared with one of the most frequent component, in each bucket
    another one, and components that meet become one; this repeats while
    components meet. Only buckets that are mixed after that are looked at
    member by member: every two members of different components whose
    signatures agree well enough are likely pairs. Of these the best one of
    every two components is confirmed first, the others only where the
    components are still apart. All links are confirmed on whole shingle sets.
    """
    rows = stage(signatures(docs, id_col, text_col, width), "signatures")
    full = rows.filter("n_shingles > 0 and id is not null")
    classes = stage(full.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "classes")
    # the id is part of the key, so copies of one text do not meet in one task
    reps = full.join(classes.select("h1", "h2", F.col("rep").alias("id")), ["h1", "h2", "id"]).select("id", "keys")
    member = _shared_buckets(reps.select("id", F.col("id").alias("label"), F.explode("keys").alias("key")))
    wanted = _named(stage(member.select("id").distinct(), "wanted"))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = stage(shingle_sets(source.join(wanted, "id", "left_semi"), width), "sets")
    # 32 bits tell one pair's common bands apart: one in 10^8 pairs at most is taken for common in a band before its first
    digests = F.transform("keys", lambda k: (k.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int"))
    marks = stage(rows.select("id", "places", "n_shingles", digests.alias("digests")).join(wanted, "id", "left_semi"), "places")
    stars = member.filter("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(verified(stars, sets, percent), "links")
    labels = components(links)
    member = stage(_relabelled(member.select("key", "id", "label"), labels), "labelled")
    for salt in range(ROUNDS):
        cells = _cells(member, salt).filter(F.col("label") != F.col("top.label"))
        low, high = F.least("label", "top.label").alias("x"), F.greatest("label", "top.label").alias("y")
        pairs = cells.select(F.least("rep", "top.rep").alias("a"), F.greatest("rep", "top.rep").alias("b"), low, high).distinct()
        names = _joined_labels(stage(_best(_agreeing(pairs, marks, percent)), "best"), sets, percent)
        if names is None:
            break
        labels = _renamed(labels, names)
        member = stage(_relabelled(member, names), "labelled")
    # rows that repeat an id bring a pair for each of their texts
    every = stage(_likely(member, marks, percent).distinct(), "likely")
    best = stage(_best(every), "best")
    names = _joined_labels(best, sets, percent)
    every = every.join(best.select("a", "b"), ["a", "b"], "left_anti")
    if names is not None:
        labels = _renamed(labels, names)
        for end in ("x", "y"):
            new = names.select(F.col("id").alias(end), F.col("component").alias("new"))
            every = every.join(new, end, "left").withColumn(end, F.coalesce("new", end)).drop("new")
        every = every.filter("x <> y").select("a", "b", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    names = _joined_labels(stage(every.select("a", "b", "x", "y"), "rest"), sets, percent)
    if names is not None:
        labels = _renamed(labels, names)
    labels = labels.withColumnRenamed("id", "rep")
    classes = classes.join(labels, "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = rows.select("id", "n_shingles", "h1", "h2").join(classes, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("id").isNotNull(), F.col("component"))).otherwise(F.col("id"))
    return out.select("id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def _renamed(labels: DataFrame, names: DataFrame) -> DataFrame:
    """``labels(id, component)`` after the components in ``names`` have met others; ids without a link yet join in."""
    new = names.select(F.col("id").alias("component"), F.col("component").alias("new"))
    old = labels.join(new, "component", "left").select("id", F.coalesce("new", "component").alias("component"))
    fresh = names.join(labels.select("id"), "id", "left_anti")
    return stage(old.union(fresh.select("id", "component")), "labels")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """The rows of ``docs`` but all near-duplicates of a row that stays.

    Rows get numbers of their own, so rows that repeat an id or have none are
    told apart, and a row that only shares its id with a copy stays. Of each
    group the row with the smallest id stays, a null one last, then the first.
    """
    number = "__near_row"
    rows = _numbered(docs, number)
    found = near_duplicates(rows, number, text_col, percent, width).select(F.col("id").alias(number), "component_id")
    found = stage(found, "components")
    named = rows.select(number, F.col(id_col).alias("name")).join(found, number)
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("name").isNull(), "name", number)).alias("first"))
    gone = stage(found.join(first.select(F.col(f"first.{number}").alias(number)), number, "left_anti").select(number), "gone")
    return rows.join(_named(gone), number, "left_anti").select(*docs.columns)


def _numbered(docs: DataFrame, number: str) -> DataFrame:
    """``docs`` with a number of each row that is the same at every reading.

    Rows of files are known by their file and place in it. Others are written
    once, since a number drawn while reading would change with the number of
    executors.
    """
    if "_metadata" not in docs.columns:
        try:
            placed = docs.select("*", F.col("_metadata.file_path").alias("__near_file"), F.col("_metadata.row_index").alias("__near_at"))
        except AnalysisException:
            placed = None
        if placed is not None:
            at = F.row_number().over(Window.orderBy("__near_file")).cast("long")
            files = stage(placed.select("__near_file").distinct().select("__near_file", at.alias("__near_number")), "files")
            # the driver holds the same list of files to plan the reading
            placed = placed.join(F.broadcast(files), "__near_file")
            value = F.shiftleft("__near_number", 40) + F.col("__near_at")
            return placed.withColumn(number, value).drop("__near_file", "__near_at", "__near_number")
    return stage(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
