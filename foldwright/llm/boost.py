"""Quality classifier (operator 8): histogram gradient-boosted trees over statistics of texts.

Trees are grown on the driver on a bounded sample of labelled rows and
flattened into arrays; every text is scored where its statistics are, by
walking all rows down each tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.llm.stats import COUNTS, SHARES, labelled_sample, text_stats
from foldwright.session import stage

FEATURES = [*COUNTS, *SHARES]
SAMPLE_ROWS = 20_000


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth, node ``k`` having the children ``2k+1`` and ``2k+2``."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.start)
        inner = self.feature.shape[1]
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def bins(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Limits between bins of each column, at its quantiles."""
    return [np.unique(np.quantile(column, np.linspace(0, 1, most + 1)[1:-1])) for column in x.T]


def grow_tree(codes: np.ndarray, limits: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, damping: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree, level by level; every level takes one histogram of all nodes for each column."""
    n, d = codes.shape
    width = max(len(x) for x in limits) + 1
    inner = (1 << depth) - 1
    feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(n, np.int64)
    for level in range(depth):
        count, first = 1 << level, (1 << level) - 1
        local = node - first
        best = np.full(count, 1e-6)
        choice = np.full((count, 2), -1)
        for j in range(d):
            if not len(limits[j]):
                continue
            cell = local * width + codes[:, j]
            g = np.cumsum(np.bincount(cell, gradient, count * width).reshape(count, width), axis=1)
            h = np.cumsum(np.bincount(cell, hessian, count * width).reshape(count, width), axis=1)
            g_all, h_all = g[:, -1:], h[:, -1:]
            gain = g**2 / (h + damping) + (g_all - g) ** 2 / (h_all - h + damping) - g_all**2 / (h_all + damping)
            gain[(h < least) | (h_all - h < least)] = -np.inf
            gain = gain[:, : len(limits[j])]
            top = gain.argmax(axis=1)
            value = gain[np.arange(count), top]
            better = value > best
            best[better], choice[better, 0], choice[better, 1] = value[better], j, top[better]
        split = choice[:, 0] >= 0
        at = first + np.flatnonzero(split)
        feature[at] = choice[split, 0]
        limit[at] = [limits[j][b] for j, b in choice[split]]
        # rows of a node that is not split all go left
        goes = np.zeros(n, bool)
        moved = split[local]
        goes[moved] = codes[np.flatnonzero(moved), choice[local[moved], 0]] > choice[local[moved], 1]
        node = 2 * node + 1 + goes
    leaf = node - inner
    value = -np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, hessian, inner + 1) + damping)
    return feature, limit, value, leaf


def train(x: np.ndarray, y: np.ndarray, rounds: int = 120, depth: int = 4, rate: float = 0.1, most_bins: int = 64, damping: float = 1.0, least: float = 1.0) -> Trees:
    """Boosting of the log loss; with one class or no rows the start value alone is left."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    if len(np.unique(y)) < 2:
        return Trees(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), depth)
    limits = bins(x, most_bins)
    codes = np.column_stack([np.searchsorted(limits[j], x[:, j], side="left") for j in range(x.shape[1])])
    margin = np.full(len(y), start)
    features, cuts, values = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        feature, limit, value, leaf = grow_tree(codes, limits, p - y, p * (1 - p), depth, damping, least)
        margin += rate * value[leaf]
        features.append(feature)
        cuts.append(limit)
        values.append(rate * value)
    return Trees(start, np.array(features), np.array(cuts), np.array(values), depth)


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", limit: float = 0.7, sample_rows: int = SAMPLE_ROWS, **options) -> DataFrame:
    """``(id, held_out, score, predicted)`` for each row; a null text counts as empty, a null id is never held out.

    Learns from at most ``sample_rows`` labelled rows that are not held out;
    scores use statistics of the text and nothing else.
    """
    stats = stage(text_stats(docs, id_col, text_col), "stats")
    known = labels.filter(~held_out(label_id))
    rows = labelled_sample(docs, known, id_col, text_col, label_id, label_col, sample_rows)
    model = train(rows[FEATURES].to_numpy(float), rows["label"].to_numpy(float), **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy().astype(float) for i in range(2, len(FEATURES) + 2)])
            score = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= limit).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return stats.select("id", held_out("id").alias("held_out"), *FEATURES).mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int")
