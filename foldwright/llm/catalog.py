"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.llm import boost, html, licenses, mixing, near, nearest, pack, periods, pieces, repeats, rules, secrets, whiten
from foldwright.llm.registry import QUERIES, TWINS, query, table

__all__ = ["QUERIES", "TWINS", "TOKENIZER", "PIECE_MODEL", "looped"]

#: the public vocabulary files that production queries use
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][place % 3 + 1]::BIGINT AS weight FROM s),
r AS (
  SELECT *, (150 * sum(source_size) OVER ())::BIGINT AS wanted,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS caps_before,
         (sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights_on
  FROM w),
p AS (SELECT *, 100 * cap * weights_on <= weight * (wanted - 100 * caps_before) AS stops FROM r),
q AS (
  SELECT *, coalesce(sum(CASE WHEN stops THEN cap END) OVER (), 0)::BIGINT AS stopped,
         (sum(CASE WHEN NOT stops THEN weight END) OVER ())::BIGINT AS opened
  FROM p),
t AS (
  SELECT source, source_size,
         CASE WHEN stops THEN cap::DOUBLE
              ELSE (weight * (wanted - 100 * stopped))::DOUBLE / (100 * opened)::DOUBLE END AS target
  FROM q),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
o AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs,
         floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k))::BIGINT - d.size AS before
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM o
"""


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400).withColumnRenamed("id", "doc_id")


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


@query("op3_mix_sources", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), percent=150, epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_collision_counting_ann")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=20, k=20)
    return found.withColumnRenamed("id", "vec_id")


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op6_site_style_tree")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query("op7_minimum_bin_slack")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=1).withColumnRenamed("id", "doc_id")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boost.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


@query("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), percent=85).withColumnRenamed("id", "doc_id")


def looped(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` in which every tenth document by a hash of its id repeats part of its words to its end.

    With ``h`` the crc32 of the id as text and ``g = floor(h / 10)``, a document
    of ``n`` words with ``h % 10 = 0`` has word ``a + (i - a) % p`` at every
    ``i >= a``, where ``a = g % n`` and ``p = 1 + floor((n - a) / (3 + g % 8))``.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))
    picked = docs.select("doc_id", "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("loops"), F.expr("crc32(cast(doc_id as string)) div 10").alias("g"))
    picked = picked.withColumn("w", F.when(F.col("loops"), words)).withColumn("n", F.size("w"))
    # -1 or 0 words leave the text as it is; their divisor is never used
    picked = picked.withColumn("a", F.col("g") % F.when(F.col("n") > 0, F.col("n")))
    picked = picked.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    places = F.sequence(F.lit(0), F.col("n") - 1)
    index = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    text = F.array_join(F.transform(places, lambda i: F.get("w", index(i).cast("int"))), " ")
    return picked.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.periodic_runs(looped(table(spark, sf_dir, "documents")))
    # the longest run, the first of equals, the shortest period then
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    digest = F.sha2(F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(""), 256)
    rows = found.select("id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), digest.alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_runs", (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query("op12_sentencepiece")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    covered = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda s, x: s + x["ends"] - x["starts"])
    return found.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        "n_bytes", covered.alias("covered_bytes"),
    )


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
