"""Statistics of whole texts, for quality rules (2) and the quality classifier (8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.llm import texts
from foldwright.llm.texts import MULTIPLIER, U64, mix
from foldwright.session import stage

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = [
    "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "punct_share", "bang_share",
    "pipe_share", "wide_share", "line_words", "distinct_share", "long_word_share", "word_spread", "byte_entropy", "repeat5_share", "period_share", "upper_word_share",
]
#: texts measured together: about a hundred times as many bytes are in use meanwhile
BLOCK_BYTES = 1 << 19
SYMBOLS = b"#*$%&|<>"


def _flags(codes: bytes | range) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(codes)] = True
    return flags


IS_SYMBOL, IS_UPPER, IS_DIGIT = _flags(SYMBOLS), _flags(range(65, 91)), _flags(range(48, 58))
IS_PUNCT, IS_BANG, IS_PIPE, IS_WIDE = _flags(b".,;:!?\"'()-"), _flags(b"!"), _flags(b"|"), _flags(range(128, 256))
IS_START = ~_flags(range(128, 192))


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[at[1:]] - total[at[:-1]]


def _repeats(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash occurs twice or more in its text."""
    _, place, times = np.unique(mix(hashes + doc.astype(U64) * MULTIPLIER), return_inverse=True, return_counts=True)
    return times[place] > 1


def _covered(hashes: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Words inside a window of ``width`` words that occurs twice or more in its text."""
    cover = np.zeros(len(hashes), bool)
    if len(hashes) >= width:
        windows = texts.window_hashes(hashes, width)
        whole = np.flatnonzero(doc[: len(windows)] == doc[width - 1 :])
        twice = whole[_repeats(doc[whole], windows[whole])]
        for i in range(width):
            cover[twice + i] = True
    return cover


def measure(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``COUNTS`` and ``SHARES`` for each text; shares of empty texts are 0."""
    n, size = len(at) - 1, np.diff(at)
    start, end, doc = texts.words(data, at)
    hashes = texts.word_hashes(data, start, end)
    by_doc = lambda x=None: np.bincount(doc, weights=x, minlength=n)
    words = by_doc()
    chars_before = np.concatenate(([0], np.cumsum(IS_START[data])))
    long = chars_before[end] - chars_before[start]
    # lines: limits are texts' limits and line feeds
    feeds = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate((at[:-1][size > 0], feeds + 1)))
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    line_doc = np.searchsorted(at, line_start, side="right") - 1
    line_end = line_end - (data[line_end - 1] == 10) if len(line_end) else line_end
    holds = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_doc = line_start[holds], line_end[holds], line_doc[holds]
    line_hash = mix(texts.Rolling(data).spans(line_start, line_end) + (line_end - line_start).astype(U64) * MULTIPLIER)
    lines = np.bincount(line_doc, minlength=n)
    _, first = np.unique(mix(line_hash + line_doc.astype(U64) * MULTIPLIER), return_index=True)
    dup_lines = lines - np.bincount(line_doc[first], minlength=n)
    symbols = _per_text(IS_SYMBOL[data], at)
    repeat = by_doc(_covered(hashes, doc, 3))
    _, first = np.unique(mix(hashes + doc.astype(U64) * MULTIPLIER), return_index=True)
    bytes_, words_, lines_ = np.maximum(size, 1), np.maximum(words, 1), np.maximum(lines, 1)
    word_chars = by_doc(long)
    mean = word_chars / words_
    entropy = np.zeros(n)
    for i in range(n):
        c = np.bincount(data[at[i] : at[i + 1]], minlength=256)
        p = c[c > 0] / max(1, size[i])
        entropy[i] = -(p * np.log2(p)).sum()
    upper_words = IS_UPPER[data[start]] & IS_UPPER[data[end - 1]] & (end - start > 1) if len(start) else np.zeros(0, bool)
    columns = [
        words, word_chars, symbols, dup_lines, repeat,
        mean, symbols / words_, dup_lines / lines_, repeat / words_, *(_per_text(f[data], at) / bytes_ for f in (IS_UPPER, IS_DIGIT, IS_PUNCT)),
        _per_text(IS_BANG[data], at) / words_, _per_text(IS_PIPE[data], at) / words_, _per_text(IS_WIDE[data], at) / bytes_, words / lines_,
        np.bincount(doc[first], minlength=n) / words_, by_doc(long > 12) / words_, np.sqrt(np.maximum(by_doc(long.astype(float) ** 2) / words_ - mean**2, 0)),
        entropy, by_doc(_covered(hashes, doc, 5)) / words_, _per_text(data == 46, at) / words_, by_doc(upper_words) / words_,
    ]
    return np.column_stack(columns).astype(float)


def text_stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, *COUNTS, *SHARES)`` of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in texts.blocks(batch.column(1), BLOCK_BYTES):
                values = measure(data, at)
                columns = [pa.array(values[:, i].astype(np.int64)) for i in range(len(COUNTS))]
                columns += [pa.array(values[:, i]) for i in range(len(COUNTS), values.shape[1])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], names=["id", *COUNTS, *SHARES])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *(f"{c} long" for c in COUNTS), *(f"{c} double" for c in SHARES)])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, rows: int):
    """Statistics of at most ``rows`` labelled documents as pandas, chosen by a hash of the id: the same in every run.

    Ids of documents and labels are joined before the limit, so labels of other
    documents cost no place; only the chosen texts are measured. An id counts
    once: labels that disagree give the lowest, and of documents that share an
    id the one with the least statistics is learned from.
    """
    marks = labels.select(F.col(label_id).alias("label_id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1) and label_id is not null")
    marks = marks.groupBy("label_id").agg(F.min("label").alias("label"))
    known = docs.select(F.col(id_col).alias("label_id")).filter("label_id is not null").distinct()
    marks = marks.join(known, "label_id").orderBy(F.xxhash64("label_id"), "label_id").limit(rows)
    # at most ``rows`` ids
    marks = stage(marks, "sample")
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks.select(F.col("label_id").alias("id"))), "id", "left_semi")
    names = [*COUNTS, *SHARES]
    stats = text_stats(chosen, "id", "text").groupBy("id").agg(F.min(F.struct(*names)).alias("s"))
    joined = stats.join(F.broadcast(marks), F.col("id") == F.col("label_id")).select("id", "label", "s.*")
    return joined.toPandas().sort_values(["id", "label"], kind="stable")
