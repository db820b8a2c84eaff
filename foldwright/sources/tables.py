"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from foldwright.functions.scalars import nan_to_null


def read_parquet(spark: SparkSession, path: str, nan_as_null: bool = True) -> DataFrame:
    """A Parquet table; NaN in floating columns becomes null."""
    df = spark.read.parquet(path)
    return nan_to_null(df) if nan_as_null else df


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, **options: str) -> DataFrame:
    """A CSV table with a header and a declared schema (nothing is inferred)."""
    return nan_to_null(spark.read.schema(schema).options(header="true", **options).csv(path))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")
