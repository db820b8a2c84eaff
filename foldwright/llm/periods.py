"""Periodic runs of words (operator 11): recursive frequency splitting, then a scan over lags.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal) of at least ``max(12, 2 * q)`` words that cannot be extended. Each of its
words therefore stands again within ``q`` places, which is at most half of any
segment that holds the run.

Splitting. A text starts as one segment. A word that does not occur again within
half a segment's length is too rare there to belong to a run and splits the
segment; parts of under 12 words are dropped, and parts are looked at again, with
occurrences counted inside the part, until none splits. Every run lies whole
in a surviving segment.

Lags. In survivors lags under 12 are compared word by word. A longer lag ``q``
with ``2B <= q < 4B`` (``B`` = 6, 12, 24, ...) has equal words over ``q >= 2B``
places, so some block of ``B`` words at a multiple of ``B`` equals the block
``q`` further on: each block is compared with ``2B`` windows, two comparisons a
word and scale. Blocks that agree are extended word by word to whole runs. Of
several lags with the same limits the least is the period.

All texts of a block of input are split and scanned together; texts are kept
apart by marks that equal no word. A null text has no words. Nothing is moved
between machines. Repeated rows and ids, also null ones, are rows of their own;
other columns play no part, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.llm import texts
from foldwright.llm.texts import MULTIPLIER, U64, mix, salted

LEAST = 12
_CELLS = 1 << 20


def split_rare(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in surviving segments, ascending, and the number of each one's segment."""
    at = np.arange(len(word))
    segment = doc.astype(np.int64)
    kept_at: list[np.ndarray] = []
    kept_segment: list[np.ndarray] = []
    numbers = 0
    while len(at):
        # number segments and drop short ones
        fresh = np.ones(len(at), bool)
        fresh[1:] = (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)
        number = np.cumsum(fresh) - 1
        size = np.bincount(number)
        enough = (size >= LEAST)[number]
        at, segment, number = at[enough], segment[enough], number[enough]
        if not len(at):
            break
        # the nearest equal word of the same segment
        key = mix(word[at] + number.astype(U64) * MULTIPLIER)
        order = np.argsort(key, kind="stable")
        gap = np.where(key[order][1:] == key[order][:-1], at[order][1:] - at[order][:-1], len(word))
        far = np.full(1, len(word))
        nearest = np.empty(len(at), np.int64)
        nearest[order] = np.minimum(np.concatenate((far, gap)), np.concatenate((gap, far)))
        rare = 2 * nearest > size[number]
        splits = np.zeros(len(size), bool)
        splits[number[rare]] = True
        done = ~splits[number]
        kept_at.append(at[done])
        kept_segment.append(number[done] + numbers)
        numbers += len(size)
        left = ~done & ~rare
        at, segment = at[left], number[left]
    if not kept_at:
        return at, segment
    at, segment = np.concatenate(kept_at), np.concatenate(kept_segment)
    order = np.argsort(at)
    return at[order], segment[order]


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the runs of true values."""
    edge = np.diff(np.concatenate(([False], equal, [False])).astype(np.int8))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def _reach(y: np.ndarray, start: np.ndarray, lag: np.ndarray, most: int, step: int) -> np.ndarray:
    """How many words, ``most`` at most, agree with those ``lag`` further on, from ``start`` in direction ``step``."""
    out = np.empty(len(start), np.int64)
    rows = max(1, _CELLS // most)
    offset = step * np.arange(most)
    for a in range(0, len(start), rows):
        place = start[a : a + rows, None] + offset
        other = place + lag[a : a + rows, None]
        inside = (place >= 0) & (other < len(y))
        same = inside & (y[np.where(inside, place, 0)] == y[np.where(inside, other, 0)])
        out[a : a + rows] = np.where(same.all(axis=1), most, same.argmin(axis=1))
    return out


def runs_in(y: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """``(start, end, period)`` of all runs in ``y``, in which a mark of its own follows each segment."""
    found: list[np.ndarray] = []
    total = len(y)
    # of the runs known so far that hold a word, the end and period of the one that ends last
    end, period = np.zeros(total, np.int64), np.ones(total, np.int64)

    def note(start: np.ndarray, stop: np.ndarray, lag: np.ndarray) -> None:
        rows = np.unique(np.stack([start, stop, lag], axis=1), axis=0)
        found.append(rows)
        for a, b, q in rows:
            later = np.flatnonzero(end[a:b] < b) + a
            end[later], period[later] = b, q

    for q in range(1, min(LEAST, total)):
        start, length = _stretches(y[:-q] == y[q:])
        good = length >= max(LEAST - q, q)
        start, length = start[good], length[good]
        if len(start):
            note(start, start + length + q, np.full(len(start), q))
    place = np.arange(total)
    width = 6
    window = np.zeros(total, U64)
    for i in range(width):
        window[: total - i] = window[: total - i] * MULTIPLIER + y[i:]
    window = mix(window)
    while len(y):
        # only segments that can hold two periods stay
        size = np.bincount(segment)[segment] - 1
        keep = size >= 4 * width
        y, segment, place, window = y[keep], segment[keep], place[keep], window[keep]
        n = len(y)
        if n < 4 * width:
            break
        blocks = np.arange(0, n - width + 1, width)
        padded = np.concatenate((window, salted(5) + np.arange(4 * width, dtype=U64)))
        ahead = np.lib.stride_tricks.sliding_window_view(padded, 2 * width)[blocks + 2 * width]
        agree = ahead == window[blocks][:, None]
        if agree.any():
            edge = np.zeros((len(blocks) + 1, 2 * width), np.int8)
            edge[:-1] += agree
            edge[1:] -= agree
            # heads and tails of the chains of one lag alternate
            lag, head = np.nonzero(edge.T == 1)
            tail = np.nonzero(edge.T == -1)[1]
            lag = lag + 2 * width
            first, last = blocks[head], blocks[tail - 1] + width
            # a power of a shorter period is no period of its own
            known = (end[place[first]] >= place[first] + lag) & (lag % period[place[first]] == 0)
            lag, first, last = lag[~known], first[~known], last[~known]
            back = _reach(y, first - 1, lag, width, -1)
            on = _reach(y, last, lag, width, 1)
            good = last + on - first + back >= lag
            start = place[(first - back)[good]]
            if len(start):
                note(start, start + (last + on - first + back + lag)[good], lag[good])
        longer = np.concatenate((window[width:], salted(7) + np.arange(width, dtype=U64)))
        window = mix(window * MULTIPLIER + longer[:n] + U64(width))
        width *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[first]


def periodic(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """``(start, end, period)`` of every run among the words of many texts, by start, then period; ``doc`` is ascending."""
    at, segment = split_rare(word, doc)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = segment[1:] != segment[:-1]
    number = np.cumsum(fresh) - 1
    to = np.arange(len(at)) + number
    y = mix(np.arange(len(at) + number[-1] + 1, dtype=U64) + salted(11))
    y[to] = mix(word[at] + number.astype(U64) * MULTIPLIER)
    segments = np.zeros(len(y), np.int64)
    segments[to[fresh]] = 1
    source = np.zeros(len(y), np.int64)
    source[to] = at
    rows = runs_in(y, np.cumsum(segments) - 1)
    rows = np.stack([source[rows[:, 0]], source[rows[:, 0]] + rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, n: int) -> pa.Array:
    """The given words of each text joined by one space."""
    length = end - start + 1
    to = np.concatenate(([0], np.cumsum(length)))
    source = np.repeat(start - to[:-1], length) + np.arange(to[-1])
    out = data[np.minimum(source, len(data) - 1)] if len(start) else np.zeros(0, np.uint8)
    out[to[1:] - 1] = 32
    # the space after a text's last word goes
    count = np.bincount(doc, minlength=n)
    final = np.cumsum(count)
    keep = np.ones(len(out), bool)
    keep[to[final[count > 0]] - 1] = False
    limit = to[final] - np.cumsum(count > 0)
    offsets = np.concatenate(([0], limit)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out[keep]))])


def _kept(runs: np.ndarray, n: int) -> np.ndarray:
    """Words in no run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, runs, kept_text)`` for each row of ``docs``.

    ``runs`` is an array of ``(start, length, period)`` by start, then period,
    in words from 0; ``kept_text`` holds the words that no run repeats, joined
    by one space.
    """
    fields = ["start", "length", "period"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in texts.blocks(batch.column(1)):
                n = b - a
                start, end, doc = texts.words(data, at)
                count = np.bincount(doc, minlength=n)
                first = np.concatenate(([0], np.cumsum(count)))
                runs = periodic(texts.word_hashes(data, start, end), doc)
                kept = _kept(runs, len(start))
                owner = doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
                values = [runs[:, 0] - first[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
                limits = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int32)
                rows = pa.ListArray.from_arrays(pa.array(limits), pa.StructArray.from_arrays([pa.array(x) for x in values], fields))
                text = _joined(data, start[kept], end[kept], doc[kept], n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), pa.array(count), rows, text], names=["id", "n_words", "runs", "kept_text"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept_text string")
