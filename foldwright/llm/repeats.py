"""Repeated byte strings (operator 1): prefix-free parsing of the corpus.

A string of ``length`` bytes that starts at two places or more is removed at
all of them. Matches stay inside one text; overlapping occurrences count.

Parsing. Rolling hashes of all ``trigger``-byte windows are taken; the trigger
of the string that starts at ``i`` is its window with the least hash (the first
of equals). Every string therefore holds its trigger, equal strings have equal
triggers at equal places, and neighbouring starts share a trigger, so a text
falls into phrases of starts with one trigger, 120 bytes on average.

Dictionary and parse. A phrase is known by its trigger's hash and by the hash of
all bytes that its strings cover (the phrase with its right context, cut at the
string length). Counting phrases by trigger settles nearly everything: a
trigger that occurs once has no repeated string; a trigger whose occurrences
all have one phrase has only repeated ones. What is left are phrases at the
ends of repeats. One copy of each such dictionary phrase is expanded into its
suffixes, and the suffixes of all phrases of one trigger are put in order; a
trigger with very many phrases has its suffixes counted row by row instead.

Order. A dictionary phrase is kept with the bytes that its strings reach beyond
it, which is what the parse says about the phrases that follow: two places whose
phrases agree but whose next phrases differ are two dictionary phrases. So one
suffix array of the dictionary, sorted byte by byte to the depth of ``length``,
holds the corpus order of all strings of a trigger, and no order of the whole
parse is computed. Strings of different triggers are never equal, so arrays of
different triggers need not be merged. A string repeats if a neighbour in its
array shares all its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.llm import texts
from foldwright.llm.texts import MULTIPLIER, U64, mix, salted
from foldwright.session import stage

#: up to so many rows are named to the readers of texts; more are joined by a shuffle of all texts
NAMED_ROWS = 1_000_000
#: phrases of one trigger that one suffix array holds, some 50 MB of strings; more are counted suffix by suffix
CONTEXTS = 1_024
#: starts that one step looks at; longer texts are looked at in pieces that overlap by the string length
STEP = 1 << 20
#: bits of a place in a block or piece, which both stay under twice a step
PLACE_BITS = 21


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, U64)
    padded[: len(values)] = values
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def phrases(data: np.ndarray, at: np.ndarray, length: int, trigger: int) -> tuple[np.ndarray, ...]:
    """Phrases of the texts in one buffer: text number, first start, number of starts, trigger offset, two hashes.

    Starts and offsets are counted in the buffer.
    """
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(U64), none.astype(U64)
    roll = texts.Rolling(data)
    places = np.arange(len(data) - trigger + 1)
    window = mix(roll.spans(places, places + trigger))
    # the same for every block, so that equal strings rank their windows alike
    bits = U64(PLACE_BITS)
    ranked = ((window >> bits) << bits) | places.astype(U64)
    best = (_sliding_min(ranked, length - trigger + 1)[:n] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    starts = np.arange(n)
    doc = np.searchsorted(at, starts, side="right") - 1
    good = starts + length <= at[doc + 1]
    fresh = good.copy()
    fresh[1:] &= ~good[:-1] | (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    # a phrase ends before the next one or before the first start that has no room
    stop = np.append(first[1:], n)
    stop = np.minimum(stop, np.maximum(at[doc[first] + 1] - length + 1, 0))
    count = stop - first
    spot = best[first]
    whole = mix(roll.spans(first, stop - 1 + length) + (spot - first).astype(U64) * MULTIPLIER + count.astype(U64) * salted(3))
    return doc[first], first, count, spot, window[spot], whole


def _pieces(data: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(number of the first text, offset of the piece, bytes, offsets)``; texts longer than a step come in pieces."""
    if len(at) == 2 and len(data) > STEP + length:
        for start in range(0, len(data) - length + 1, STEP):
            piece = data[start : start + STEP + length - 1]
            yield 0, start, piece, np.array([0, len(piece)])
    else:
        yield 0, 0, data, at


def parse(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """``(r1, r2, start, n, gap, key, whole)``: the phrases of ``docs(r1, r2, text)``; ``gap`` is first start to trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r1, r2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, _, block, limits in texts.blocks(batch.column(2), 1 << 19):
                for _, offset, data, at in _pieces(block, limits, length):
                    doc, first, count, spot, key, whole = phrases(data, at, length, trigger)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r1[a + doc]), pa.array(r2[a + doc]), pa.array(first - at[doc] + offset), pa.array(count.astype(np.int32)), pa.array((spot - first).astype(np.int32)), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64))],
                        names=["r1", "r2", "start", "n", "gap", "key", "whole"],
                    )

    return docs.select("r1", "r2", "text").mapInArrow(run, "r1 long, r2 long, start long, n int, gap int, key long, whole long")


def _with_text(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows(r1, r2, ...)`` joined with their texts; few rows are named to the readers so that only their texts move."""
    if rows.count() <= NAMED_ROWS:
        docs = docs.join(F.broadcast(rows.select("r1", "r2")), ["r1", "r2"], "left_semi")
    return docs.join(rows, ["r1", "r2"])


def _dictionary(phrase_texts: DataFrame, length: int) -> DataFrame:
    """``(key, r1, r2, start, once, phrase)``: the bytes of each listed phrase with those that its strings reach beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts.utf8(batch.column(2))
            r1, r2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(s["key"], r1[i], r2[i], s["start"], s["once"], data[at[i] + s["start"] : at[i] + s["start"] + s["n"] - 1 + length].tobytes()) for i, spans in enumerate(batch.column(3).to_pylist()) for s in spans]
            kinds = (pa.int64(),) * 4 + (pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["key", "r1", "r2", "start", "once", "phrase"])

    return phrase_texts.select("r1", "r2", "text", "spans").mapInArrow(run, "key long, r1 long, r2 long, start long, once boolean, phrase binary")


def suffix_array(phrases: list[bytes], depth: int) -> tuple[list[int], list[bool]]:
    """The starts of all ``depth``-byte strings of the phrases in byte order, numbered through, and whether each equals the one before."""
    strings = [p[i : i + depth] for p in phrases for i in range(len(p) - depth + 1)]
    order = sorted(range(len(strings)), key=strings.__getitem__)
    return order, [False, *(strings[a] == strings[b] for a, b in pairwise(order))]


def _in_order(groups: DataFrame, length: int) -> DataFrame:
    """``(r1, r2, start, n)``: repeated runs among the phrases of each trigger, from their suffix array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for group in batch.column(0):
                group = group.as_py()
                order, same = (np.array(x) for x in suffix_array([x["phrase"] for x in group], length))
                met = np.zeros(len(order), bool)
                met[order[same]] = True
                met[order[:-1][same[1:]]] = True
                last = 0
                for x in group:
                    first, last = last, last + len(x["phrase"]) - length + 1
                    if x["once"]:
                        edges = np.diff(np.concatenate(([False], met[first:last], [False])).astype(np.int8))
                        for i, j in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
                            out.append((x["r1"], x["r2"], x["start"] + int(i), int(j - i)))
            kinds = (pa.int64(),) * 4
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["r1", "r2", "start", "n"])

    return groups.mapInArrow(run, "r1 long, r2 long, start long, n long")


def _suffixes(phrase_texts: DataFrame, length: int) -> DataFrame:
    """``(key, r1, r2, start, once, gap, prints)``: the fingerprints of all strings of each listed phrase, for triggers with many phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts.utf8(batch.column(2))
            r1, r2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, spans in enumerate(batch.column(3).to_pylist()):
                text, prints = data[at[i] : at[i + 1]], []
                for s in spans:
                    place = np.arange(s["n"])
                    prints.append(mix(texts.Rolling(text[s["start"] : s["start"] + s["n"] - 1 + length]).spans(place, place + length)).tobytes())
                columns = [pa.array([s[k] for s in spans], t) for k, t in (("key", pa.int64()), ("start", pa.int64()), ("once", pa.bool_()), ("gap", pa.int32()))]
                named = [pa.array([r1[i]] * len(spans), pa.int64()), pa.array([r2[i]] * len(spans), pa.int64())]
                yield pa.RecordBatch.from_arrays([columns[0], *named, *columns[1:], pa.array(prints, pa.binary())], names=["key", "r1", "r2", "start", "once", "gap", "prints"])

    return phrase_texts.select("r1", "r2", "text", "spans").mapInArrow(run, "key long, r1 long, r2 long, start long, once boolean, gap int, prints binary")


def _exploded(suffixes: DataFrame) -> DataFrame:
    """As ``_in_order`` for triggers with too many phrases for one task: a row for each suffix, counted by fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, r1, r2, start, once, gap, prints in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.frombuffer(prints, np.int64)
                place = np.arange(len(found))
                same = [pa.array(np.full(len(found), x)) for x in (key, r1, r2, start, once)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(place), pa.array(gap - place), pa.array(found)], names=["key", "r1", "r2", "start", "once", "place", "ahead", "print"])

    rows = stage(suffixes.mapInArrow(run, "key long, r1 long, r2 long, start long, once boolean, place long, ahead long, print long"), "suffixes")
    order = ["key", "ahead", "print"]
    met = rows.groupBy(*order).agg(F.count("*").alias("copies")).filter("copies > 1").select(*order)
    found = rows.filter("once").join(met, order, "left_semi")
    found = found.groupBy("r1", "r2", "start").agg(F.sort_array(F.collect_list("place")).alias("places"))
    runs = found.select("r1", "r2", "start", F.explode(_runs("places")).alias("r"))
    return runs.select("r1", "r2", (F.col("start") + F.col("r.at")).alias("start"), F.col("r.n").alias("n"))


def repeated_spans(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """``(r1, r2, start, n)``: runs of starts in ``docs(r1, r2, text)`` whose strings start elsewhere too."""
    # parsing twice takes less than keeping the phrases of all texts
    parsed = parse(docs, length, trigger)
    triggers = parsed.groupBy("key").agg(F.count("*").alias("times"), F.min("whole").alias("low"), F.max("whole").alias("high"))
    triggers = stage(triggers.filter("times > 1").select("key", (F.col("low") != F.col("high")).alias("mixed")), "triggers")
    candidates = stage(parsed.join(triggers, "key"), "candidates")
    ends = candidates.filter("mixed")
    # one copy of each dictionary phrase
    chosen = ends.groupBy("key", "whole", "n", "gap").agg(F.count("*").alias("times"), F.min(F.struct("r1", "r2", "start")).alias("one"))
    chosen = stage(chosen.select("key", "whole", "n", "gap", (F.col("times") == 1).alias("once"), "one.*"), "dictionary")
    many = ends.join(chosen.filter("not once").select("key", "whole"), ["key", "whole"], "left_semi")
    settled = candidates.filter("not mixed").union(many.select(*candidates.columns)).select("r1", "r2", "start", F.col("n").cast("long").alias("n"))
    # triggers whose phrases all occur often have nothing left to settle
    contexts = chosen.groupBy("key").agg(F.count("*").alias("contexts"), F.bool_or("once").alias("open")).filter("open")
    rows = stage(chosen.join(contexts.select("key", (F.col("contexts") > CONTEXTS).alias("hot")), "key"), "open")
    span = F.struct("start", "n", "gap", "key", "once")
    listed = stage(rows.filter("not hot").groupBy("r1", "r2").agg(F.collect_list(span).alias("spans")), "listed")
    dictionary = _dictionary(_with_text(docs, listed), length)
    phrase = F.struct("r1", "r2", "start", "once", "phrase")
    found = _in_order(dictionary.groupBy("key").agg(F.collect_list(phrase).alias("phrases")).select("phrases"), length)
    hot = stage(rows.filter("hot").groupBy("r1", "r2").agg(F.collect_list(span).alias("spans")), "listed")
    if not hot.isEmpty():
        found = found.union(_exploded(_suffixes(_with_text(docs, hot), length)))
    return settled.union(found)


def _runs(places: str):
    """Runs of consecutive numbers in a sorted array, as ``(at, n)``."""
    p = F.col(places)
    heads = F.filter(p, lambda x, i: (i == 0) | (F.get(p, i - 1) != x - 1))
    tails = F.filter(p, lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) != x + 1))
    return F.zip_with(heads, tails, lambda a, b: F.struct(a.alias("at"), (b - a + 1).alias("n")))


def _merged(spans: list, length: int, size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, n in sorted((s["start"], s["n"]) for s in spans):
        end = min(start + n - 1 + length, size)
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, trigger: int = 160, keep_text: bool = False) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` for each row of ``docs``, and the text left with ``keep_text``.

    A null text counts as empty. Rows are known by 128 bits over their id, whether
    it is null, and their text, so rows that repeat an id, also a null one, are
    rows of their own, and a repeated row is a copy like any other.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # two hashes in which text, id and the mark of a null id stand in different order
    first, second = F.xxhash64("text", F.col("id").isNull(), "id"), F.xxhash64(F.lit(7), "id", F.col("id").isNull(), "text")
    named = source.select(first.alias("r1"), second.alias("r2"), "id", "text")
    spans = repeated_spans(named, length, trigger)
    listed = stage(spans.groupBy("r1", "r2").agg(F.collect_list(F.struct("start", "n")).alias("spans")), "spans")
    if listed.count() <= NAMED_ROWS:
        # texts without repeats stay where they are read
        marked = named.join(F.broadcast(listed.select("r1", "r2", F.lit(True).alias("mark"))), ["r1", "r2"], "left")
        hit = marked.filter("mark").select("r1", "r2", "id", "text").join(listed, ["r1", "r2"]).select("id", "text", "spans")
        clean = marked.filter("mark is null").select("id", "text", F.lit(None).cast(listed.schema["spans"].dataType).alias("spans"))
        joined = [clean, hit]
    else:
        joined = [named.join(listed, ["r1", "r2"], "left").select("id", "text", "spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts.utf8(batch.column(1))
            spans = batch.column(2).to_pylist()
            out = []
            for i in range(batch.num_rows):
                raw = data[at[i] : at[i + 1]].tobytes()
                gone = _merged(spans[i], length, len(raw)) if spans[i] else []
                left, last = [], 0
                for a, b in gone:
                    left.append(raw[last:a])
                    last = b
                left = b"".join([*left, raw[last:]])
                out.append((len(raw), len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest(), left))
            columns = [batch.column(0), *(pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array([x[4] for x in out], pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_text else "")
    parts = [part.mapInArrow(run, schema) for part in joined]
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])
