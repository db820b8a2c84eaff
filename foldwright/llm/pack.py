"""Packing (operator 7): token pieces into sequences by minimum bin slack.

A null text counts as empty and holds its end id only; ids of documents may be
null or repeat, each row is packed on its own.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwright.llm import texts
from foldwright.session import small_batches, stage

#: kept by a Python worker: runs as they stand, and the parts that cost an encoding
KEPT_RUNS, KEPT_PARTS = 100_000, 600_000
BUCKET_ROWS = 10_000
#: controls that str.split() takes for white space and the tokenizer does not
CONTROLS = re.compile("[\x1c-\x1f]")
#: Latin letters whose lower case does not depend on their neighbours, and ASCII marks but the apostrophe
LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: parts of runs: letters that only marks follow, the marks at the end of a run, or the whole run
PARTS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[!-&(-/:-@\[-`{-~]*+(?!\S))|[!-&(-/:-@\[-`{-~]++(?!\S)|\S+")
#: what lower case may change otherwise than the tokenizer does: letters beyond Latin-1, and special tokens
WIDE = re.compile("[^\x00-\xff]|<\\|")


class Pieces(dict):
    """Ids of runs without white space, found on first use."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, run: str) -> bytes:
        ids = self[run] = self.find(run)
        return ids


class WordEncoder:
    """Token ids of texts as little-endian 32-bit words, with encoded words kept.

    The tokenizer normalises code points, drops white space and merges inside
    runs without white space, so encoding such runs one by one gives the ids of
    the whole text. It lowers case and parts letters from marks, so a run of
    letters with marks behind it has the ids of its letters in lower case and
    then those of the marks.
    """

    def __init__(self, path: str, kept: tuple[int, int] = (KEPT_RUNS, KEPT_PARTS)):
        self.most = kept
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.parts = Pieces(lambda run: array("I", tokenizer.encode(run, add_special_tokens=False).ids).tobytes())
        self.runs = Pieces(self._run)
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _run(self, run: str) -> bytes:
        plain = LETTERS.fullmatch(run)
        if plain is None:
            return self.parts[run]
        marks = plain[2]
        return self.parts[plain[1].lower()] + (self.parts[marks] if marks else b"")

    def _learn(self, words: list[str]) -> None:
        """Encode words of letters as one text; the tokens that end a word tell them apart."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        # else one by one, on first use
        if len(stops) == len(words) and stops[-1] == 4 * len(ids):
            whole = ids.tobytes()
            self.parts.update(zip(words, map(whole.__getitem__, map(slice, [0, *stops], stops))))

    def encode(self, text: str) -> bytes:
        for kept, most in zip((self.runs, self.parts), self.most, strict=True):
            if len(kept) > most:
                kept.clear()
        if CONTROLS.search(text):
            return b"".join(map(self.runs.__getitem__, re.split("[ \t-\r]+", text.strip(" \t\n\v\f\r"))))
        # cutting the whole text at once spares a search for each new run
        found = PARTS.findall(text if WIDE.search(text) else text.lower())
        new = [part for part in set(found) if part not in self.parts and part.isalpha()]
        if len(new) > 1:
            self._learn(new)
        return b"".join(map(self.parts.__getitem__, found))


@lru_cache(maxsize=1)
def encoder_for(path: str, kept: tuple[int, int] = (KEPT_RUNS, KEPT_PARTS)) -> WordEncoder:
    """One encoder for each Python worker, so that what it knows serves all tasks of the worker."""
    return WordEncoder(path, kept)


def token_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end_id: int, kept: tuple[int, int] = (KEPT_RUNS, KEPT_PARTS)) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens)``: full pieces of ``capacity`` ids and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer, kept)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for a, b, _, _ in texts.blocks(batch.column(1), 1 << 20):
                rows, out = [], []
                for i, text in enumerate(batch.column(1).slice(a, b - a).to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        length = min(capacity, n - start)
                        rows.append(a + i)
                        out.append((start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n))
                columns = np.array(out, dtype=np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(columns[:, k]) for k in range(4))], names=["id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset out of ``counts`` whose sum comes closest to ``room`` from below.

    Bit ``s`` of a reach says that a sum ``s`` can be made; counts are split
    into powers of two, so each length costs a few shifts. The choice is read
    back from the reaches, the last length first.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(copies, lengths with counts)`` until every length is used up.

    The largest length left opens a window and the best filling joins it; the
    window is repeated while its lengths last, as the next search would find
    the same. Each pattern uses up a length, so there are about as many
    patterns as lengths whatever the number of pieces.
    """
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        top = max(left)
        rest = dict(left)
        rest[top] -= 1
        chosen = fill({k: v for k, v in rest.items() if v}, capacity - top)
        chosen[top] = chosen.get(top, 0) + 1
        copies = min(left[k] // v for k, v in chosen.items())
        out.append((copies, chosen))
        for k, v in chosen.items():
            left[k] -= copies * v
            if not left[k]:
                del left[k]
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1, kept: tuple[int, int] = (KEPT_RUNS, KEPT_PARTS)) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row for each piece.

    Documents are cut at multiples of ``capacity``; what is left stays whole.
    The driver sees the number of pieces by length only, at most ``capacity``
    rows. Pieces get their place in their length's order from counts by bucket,
    so no length's pieces have to meet in one task. ``kept`` bounds the encoded
    runs and parts that a worker keeps; it decides speed and memory only.
    """
    with small_batches(docs.sparkSession):
        pieces = stage(token_pieces(docs, id_col, text_col, tokenizer, capacity, end_id, kept), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used, sequence = dict.fromkeys(counts, 0), 0
    for copies, chosen in patterns(counts, capacity):
        offset = 0
        for length in sorted(chosen, reverse=True):
            times = chosen[length]
            slots.setdefault(length, []).append((used[length], sequence, times, offset))
            used[length] += copies * times
            offset += length * times
        sequence += copies
    table = {k: np.array(v, dtype=np.int64) for k, v in slots.items()}

    n_buckets = max(1, sum(counts.values()) // BUCKET_ROWS)
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(n_buckets)))
    sums = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy("length", "bucket").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = bucketed.withColumn("rank", F.row_number().over(inside)).join(sums, ["length", "bucket"])
    ranked = ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("rank") - 1).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            out = np.zeros((2, len(length)), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                rows = table[int(value)]
                slot = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                step = rank[at] - slot[:, 0]
                out[0, at] = slot[:, 1] + step // slot[:, 2]
                out[1, at] = slot[:, 3] + step % slot[:, 2] * value
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out[0]), pa.array(out[1])], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(place, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
