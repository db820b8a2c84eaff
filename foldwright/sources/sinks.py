"""Writing submissions, predictions, fitted state and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foldwright.plans.ranks import ordered_index

_META = "_metadata_table"


def write_submission(
    df: DataFrame,
    path: str,
    id_col: str,
    predictions: str | Sequence[str],
    float_format: str = "%.6f",
    compression: str | None = None,
    index: bool = False,
) -> None:
    """CSV files with header: the id and formatted predictions, written in parallel.

    ``compression`` is None or gzip. Zip is not a Spark codec and is refused.
    """
    if compression not in (None, "gzip"):
        raise ValueError(f"compression must be None or 'gzip', not {compression!r}")
    predictions = [predictions] if isinstance(predictions, str) else list(predictions)
    out = df.select(id_col, *[F.format_string(float_format, F.col(p).cast("double")).alias(p) for p in predictions])
    if index:
        out = ordered_index(out, id_col, None).select("index", id_col, *predictions)
    writer = out.write.mode("overwrite").option("header", "true")
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def save_predictions(df: DataFrame, path: str, mode: str = "append") -> None:
    """``(id, model, fold, pred)`` rows, laid out so a model or fold is read alone."""
    df.write.mode(mode).partitionBy("model", "fold").parquet(path)


def load_predictions(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if models is None else df.filter(F.col("model").isin(list(models)))


def save_state(
    spark: SparkSession, path: str, tables: dict[str, DataFrame], version: str, metadata: dict[str, str] | None = None
) -> None:
    """Fitted state tables plus one metadata row each; the metadata is written last."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    lines = [(name, version, dict(metadata or {})) for name in tables]
    meta = spark.createDataFrame(lines, "name string, version string, metadata map<string, string>")
    meta.write.mode("overwrite").parquet(f"{path}/{_META}")


def load_state(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], str, dict[str, str]]:
    """The tables, their version and metadata."""
    lines = spark.read.parquet(f"{path}/{_META}").collect()
    tables = {r["name"]: spark.read.parquet(f"{path}/{r['name']}") for r in lines}
    return tables, lines[0]["version"], lines[0]["metadata"]


def append_log(df: DataFrame, path: str) -> None:
    """Append prediction log rows, one folder per day so that a report reads few files."""
    day = F.to_date(F.col("timestamp"))
    df.withColumn("day", day).write.mode("append").partitionBy("day").parquet(path)


def stream_log(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same from a stream, everything available now."""
    writer = df.withColumn("day", F.to_date(F.col("timestamp"))).writeStream.format("parquet")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).partitionBy("day")
    return writer.trigger(availableNow=True).start()
