"""Running a stream over everything available, into a table of the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.session import scratch_path


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet", files_per_trigger: int = 64
) -> DataFrame:
    """New Parquet files of a folder as a stream; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def event_time(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need a zoned timestamp; zone-free ones are taken as UTC (the session zone)."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def run_available(df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run to the end of the available input and return the result table."""
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    _to_the_end(df, path, checkpoint, mode)
    return spark.read.schema(df.schema).parquet(path)


def _to_the_end(df: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: the time of the row that ends a stream, in microseconds: later than any calendar's
END_US = 6 * 10**18


def run_closed(rows: DataFrame, time: str, transform: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """``transform`` of a stream that ends with its available input: no row waits for a watermark.

    The input is read to its end first. Then one row at ``END_US`` comes through a
    second source of the same query, and the watermark that follows it passes
    everything still held. ``transform`` drops that row behind the watermark.
    """
    spark = rows.sparkSession
    path, checkpoint, ends = (scratch_path(spark, label + x) for x in ("", "-checkpoint", "-end"))
    end = spark.range(1).select(F.timestamp_micros(F.lit(END_US)).alias(time))
    end.limit(0).write.parquet(ends)
    df = transform(rows.unionByName(parquet_stream(spark, ends, end.schema), allowMissingColumns=True))
    _to_the_end(df, path, checkpoint, "append")
    end.write.mode("append").parquet(ends)
    _to_the_end(df, path, checkpoint, "append")
    return spark.read.schema(df.schema).parquet(path)


def run_batches(
    df: DataFrame, label: str, transform: Callable[[DataFrame], DataFrame], schema: T.StructType
) -> DataFrame:
    """Like :func:`run_available`, with a batch transformation of every emitted batch.

    Each batch writes its own folder by overwriting it, so a repeated batch
    leaves one copy.
    """
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        df.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path).select(*schema.names)
