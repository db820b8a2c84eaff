"""Size checks: a measured row count, never an estimate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A group of up to this many rows is comfortable work for one task.
HOT_ROWS = 2_000_000


def is_small(df: DataFrame, rows: int = HOT_ROWS) -> bool:
    """Whether the whole table has at most ``rows`` rows, so that no key of it can have more (one count).

    A stream is never counted; its micro-batches are as large as the trigger allows.
    """
    return df.isStreaming or df.count() <= rows


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
