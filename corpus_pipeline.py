"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but
the last return the columns of ``docs``: rules and near-duplicates drop rows,
the secret scan masks what it finds in the text, the mix repeats documents by
epoch and cuts a source's last document at the word that meets its budget. The
last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldwright.llm import mixing, near, pack, rules, secrets
from foldwright.llm.catalog import TOKENIZER
from foldwright.llm.registry import table
from foldwright.session import scratch_path, staged_tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the learned decision list."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, a null one last; of rows that share it the first read."""
    return near.keep_first(docs, percent=85)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), percent=150, epochs=2)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens; workers that served other stages keep fewer encoded words."""
    return pack.pack(docs, TOKENIZER, capacity=2048, end_id=1, kept=(50_000, 120_000)).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("secret scan", secret_scan),
    ("mixing", mix_sources),
    ("packing", packing),
]

#: rules are learned and links hashed, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        with staged_tables(spark):
            result = function(spark, docs, sf_dir)
            path = scratch_path(spark, name.replace(" ", "-"))
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
