"""Quality rules (operator 2): a learned decision list over statistics of texts.

Sequential covering: rules for rejected texts are learned one after another on
labelled rows. A rule is a conjunction of thresholds, grown on two thirds of
the rows by information gain and pruned on the rest; rows it covers leave, and
learning ends when no rule is precise enough. The list is emitted as one
ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.llm import texts
from foldwright.llm.stats import BLOCK_BYTES, COUNTS, SHARES, labelled_sample, measure, text_stats

SAMPLE_ROWS = 20_000
CUT_POINTS = 32


@dataclass(frozen=True)
class Condition:
    column: str
    above: bool
    limit: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.column] > self.limit if self.above else table[self.column] <= self.limit

    def expression(self, prefix: str = "") -> Column:
        c = F.col(prefix + self.column)
        return c > self.limit if self.above else c <= self.limit


def _covers(rule: list[Condition], table: dict[str, np.ndarray], n: int) -> np.ndarray:
    cover = np.ones(n, bool)
    for c in rule:
        cover &= c.holds(table)
    return cover


def _gain(p0: int, n0: int, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Information gain of a refinement, times the positives it keeps."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, gain, -np.inf)


def grow(table: dict[str, np.ndarray], bad: np.ndarray, columns: list[str], most: int = 4) -> list[Condition]:
    """Conditions added one by one, each the best over all columns and cut points, until only bad rows are covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        if p0 == 0 or n0 == 0:
            break
        best, choice = 1e-9, None
        for column in columns:
            values = table[column][inside]
            order = np.argsort(values, kind="stable")
            sorted_, mark = values[order], bad[inside][order]
            ends = np.flatnonzero(sorted_[1:] != sorted_[:-1])
            if not len(ends):
                continue
            # cut points lie where the values change, evenly by rank among bad rows and among all
            if len(ends) > 2 * CUT_POINTS:
                at_bad = np.flatnonzero(mark)
                marks = np.concatenate((np.linspace(0, len(order) - 2, CUT_POINTS).astype(int), at_bad[np.linspace(0, len(at_bad) - 1, CUT_POINTS).astype(int)]))
                near = np.searchsorted(ends, marks)
                ends = np.unique(ends[np.clip(np.concatenate((near - 1, near)), 0, len(ends) - 1)])
            below = np.cumsum(mark)[ends]
            p_low, n_low = below, ends + 1 - below
            for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                gain = _gain(p0, n0, p, n)
                i = int(gain.argmax())
                if gain[i] > best:
                    best, choice = gain[i], Condition(column, above, float((sorted_[ends[i]] + sorted_[ends[i] + 1]) / 2))
        if choice is None:
            break
        rule.append(choice)
        inside &= choice.holds(table)
    return rule


def prune(rule: list[Condition], table: dict[str, np.ndarray], bad: np.ndarray) -> tuple[list[Condition], float, int]:
    """The leading part of the rule that is best on held-back rows, with its precision and cover there."""
    best, kept, precision, cover = -np.inf, rule, 0.0, 0
    for k in range(len(rule), 0, -1):
        inside = _covers(rule[:k], table, len(bad))
        p, n = int(bad[inside].sum()), int((~bad[inside]).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth >= best:
            best, kept, precision, cover = worth, rule[:k], p / max(1, p + n), p + n
    return kept, precision, cover


def learn(table: dict[str, np.ndarray], bad: np.ndarray, columns: list[str], precision: float = 0.9, least: int = 3, most_rules: int = 24) -> list[list[Condition]]:
    """An ordered list of rules; every third row, in the given order, is held back for pruning."""
    rules: list[list[Condition]] = []
    open_ = np.ones(len(bad), bool)
    held = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules:
        g, h = open_ & ~held, open_ & held
        if bad[g].sum() < least:
            break
        part = lambda at: {c: table[c][at] for c in columns}
        rule = grow(part(g), bad[g], columns)
        if not rule:
            break
        rule, exact, cover = prune(rule, part(h), bad[h])
        inside = _covers(rule, table, len(bad)) & open_
        if cover < least or exact < precision or bad[inside].mean() < precision:
            break
        rules.append(rule)
        open_ &= ~inside
    return rules


def verdict(rules: list[list[Condition]], prefix: str = "") -> Column:
    """The list as one ordered conditional: false at the first rule that holds, true at its end."""
    out = None
    for rule in rules:
        test = rule[0].expression(prefix)
        for c in rule[1:]:
            test = test & c.expression(prefix)
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, **options) -> list[list[Condition]]:
    """Rules for label 0, learned on at most ``sample_rows`` labelled documents; none where a label is missing.

    A list has at most ``most_rules`` (24) rules of at most four conditions.
    """
    rows = labelled_sample(docs, labels, id_col, text_col, label_id, label_col, sample_rows)
    columns = ["n_words", *SHARES]
    return learn({c: rows[c].to_numpy(float) for c in columns}, rows["label"].to_numpy() == 0, columns, **options)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(id, counts, base_failed, kept)`` for each row; texts of under 50 words or half repeats fail, null texts too.

    Texts are measured and judged where they are read; none is moved.
    """
    rules = fit(docs, labels, id_col, text_col, **options)
    stats = text_stats(docs, id_col, text_col)
    return stats.select("id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def base_failed(prefix: str = "") -> Column:
    words, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, by the same conditional; one pass over the texts, none of which is shuffled."""
    rules = fit(docs, labels, id_col, text_col, **options)
    place, mark = docs.columns.index(text_col), "__quality_"
    names = [mark + c for c in (*COUNTS, *SHARES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in texts.blocks(batch.column(place), BLOCK_BYTES):
                values = measure(data, at)
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(values[:, i]) for i in range(len(names)))], names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    measured = docs.mapInArrow(run, schema)
    return measured.filter(~base_failed(mark) & verdict(rules, mark)).select(*docs.columns)
