"""Mixing sources to target weights (operator 3).

Documents of a source stand in the order of a hash of their id; a source gives
whole epochs and then the documents before a cut, so that its words equal the
budget. A null text has size 0. Rows that repeat an id stand at one place and
share what is taken there by size. Rows with a null id come last, in the order
of a hash of their text; those of equal text share a place. Columns of the
documents may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwright.session import stage

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 10_000
LAST = "g" * 32


def size_of(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def key_of(id_col: str, text_col: str) -> Column:
    without = F.concat(F.lit(LAST), F.coalesce(F.md5(F.col(text_col).cast("string")), F.lit("")))
    return F.coalesce(F.md5(F.col(id_col).cast("string")), without)


def targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, epochs: int) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in code point order, null last, take the weights in turn. Their
    targets share ``percent`` of all words by weight; a target stops at
    ``epochs`` times the source's size and the excess is shared again. With
    sources in the order of limit by weight those that stop come first, so one
    running sum finds them all.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")
    rows = sizes.withColumn("place", place).withColumn("weight", weight).withColumn("cap", epochs * F.col("source_size"))
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("place").asc())
    everything = W.partitionBy()
    rows = rows.withColumns(
        {
            "wanted": percent * F.sum("source_size").over(everything),
            "caps_before": F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "weights_on": F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    )
    rows = rows.withColumn("stops", 100 * F.col("cap") * F.col("weights_on") <= F.col("weight") * (F.col("wanted") - 100 * F.col("caps_before")))
    rows = rows.withColumns(
        {
            "stopped": F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(everything), F.lit(0)),
            "open": F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything),
        }
    )
    shared = (F.col("weight") * (F.col("wanted") - 100 * F.col("stopped"))).cast("double") / (100 * F.col("open")).cast("double")
    return rows.select("source", "source_size", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(shared).alias("target"))


def cuts(docs: DataFrame, weights: tuple[int, ...], percent: int, epochs: int) -> DataFrame:
    """``(source, source_size, target, whole, cut_key, cut_words, unit_words)``, one row for each source.

    The mix takes ``whole`` epochs, once more every document before ``cut_key``
    and ``cut_words`` of the ``unit_words`` that stand there. Documents are
    counted by ranges of the key first; only the range that holds a cut is
    sorted.
    """
    rows = stage(docs.groupBy("source", "key").agg(F.sum("size").alias("size")).filter("size > 0"), "sizes")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, percent, epochs)
    plan = plan.withColumn("budget", F.floor("target")).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0))
    plan = stage(plan.withColumn("left", F.col("budget") - F.col("whole") * F.col("source_size")), "targets")
    n_buckets = max(1, rows.count() // BUCKET_ROWS)
    # keys of rows without id follow all others, and one of them has no number
    late = F.col("key").startswith(LAST)
    digits = F.when(late, F.concat(F.substring("key", len(LAST) + 1, 8), F.lit("0"))).otherwise(F.concat(F.substring("key", 1, 8), F.lit("0")))
    number = F.shiftright(F.conv(digits, 16, 10).cast("long"), 4)
    bucket = F.floor(number * n_buckets / F.lit(1 << 32)) + F.when(late, n_buckets).otherwise(0)
    ranged = rows.withColumn("bucket", bucket)
    sums = ranged.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    run = W.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("through", F.sum("words").over(run))
    wanted = plan.select(F.col("source").alias("s"), "left")
    held = sums.join(wanted, F.col("source").eqNullSafe(F.col("s"))).filter((F.col("through") > F.col("left")) & (F.col("through") - F.col("words") <= F.col("left")))
    held = held.select("s", F.col("bucket").alias("held"), (F.col("through") - F.col("words")).alias("before"), "left")
    inside = ranged.join(held, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("held")))
    inside = inside.withColumn("through", F.col("before") + F.sum("size").over(W.partitionBy("s").orderBy("key")))
    cut = inside.filter((F.col("through") > F.col("left")) & (F.col("through") - F.col("size") <= F.col("left")))
    cut = cut.select("s", F.col("key").alias("cut_key"), (F.col("left") - F.col("through") + F.col("size")).alias("cut_words"), F.col("size").alias("unit_words"))
    return plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "whole", "cut_key", "cut_words", "unit_words")


def _taken(docs: DataFrame, weights: tuple[int, ...], percent: int, epochs: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``(row, size, source_size, target, taken)``; ``row`` holds all columns of ``docs``, whatever their names."""
    size, key = size_of(text_col).alias("size"), key_of(id_col, text_col).alias("key")
    small = docs.select(F.col(source_col).alias("source"), key, size)
    plan = stage(cuts(stage(small, "sizes"), weights, percent, epochs), "cuts").withColumnRenamed("source", "s")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source_col).alias("source"), size, key)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
    more = F.when(F.col("key") < F.col("cut_key"), F.col("size")).when(F.col("key") == F.col("cut_key"), F.floor(F.col("size") * F.col("cut_words") / F.col("unit_words"))).otherwise(0)
    return joined.select("row", "size", "source_size", "target", (F.col("whole") * F.col("size") + more).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, epochs: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``; extra columns stay.

    Columns of these names are replaced. Every source that has words meets the
    whole-word part of its target, exactly where no rows share a place.
    """
    new = ["size", "source_size", "target", "taken"]
    rows = _taken(docs, weights, percent, epochs, id_col, text_col, source_col)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in new], *new)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, epochs: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """The documents of the mix with the columns of ``docs``: a row for each epoch, the last one cut at its word.

    ``length_col``, if there is one, counts the text again; all other columns stay as they are.
    """
    rows = _taken(docs, weights, percent, epochs, id_col, text_col, source_col).filter("taken > 0")
    text, rest = F.col("row").getField(text_col), F.col("taken") % F.col("size")
    # words up to the cut, with the white space between them as it is
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), 0), 1, rest.cast("int")), "")
    copies = F.concat(F.array_repeat(text, F.floor(F.col("taken") / F.col("size")).cast("int")), F.when(rest > 0, F.array(head)).otherwise(F.array().cast("array<string>")))
    rows = rows.select("row", F.explode(copies).alias("copy"))
    own = {text_col: F.col("copy")}
    if length_col in docs.columns:
        own[length_col] = F.length("copy").cast(docs.schema[length_col].dataType)
    return rows.select(*[own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
