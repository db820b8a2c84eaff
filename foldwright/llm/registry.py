"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query by name, with its SQL where there is one."""

    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = function
        if sql is not None:
            TWINS[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
