"""Registered queries and, where SQL can say the same, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwright.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double so that summation order does not show in comparisons."""
    # adding zero turns -0.0 into 0.0
    out = {
        f.name: (F.round(f.name, digits) + F.lit(0.0)).alias(f.name)
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.select(*[out.get(c, F.col(c)) for c in df.columns])


def r6(col: Column | str, name: str) -> Column:
    return (F.round(col, 6) + F.lit(0.0)).alias(name)


# ------------------------------------------------------------ shared inputs


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a training table: ``y`` is 1 for finished orders."""
    return table(spark, folder, "orders").withColumn("y", (F.col("o_orderstatus") == "F").cast("int"))


ORDERS = "base AS (SELECT *, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders)"


def dealt(by: str, ids: str, source: str, seed: int = 42, k: int = 5) -> str:
    """SQL for the fold contract: equal blocks of the hash order (within ``by``)."""
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"SELECT *, CAST(ntile({k}) OVER ({part}ORDER BY md5(concat_ws('_', '{seed}', CAST({ids} AS VARCHAR))), {ids})"
        f" - 1 AS INTEGER) AS fold FROM {source}"
    )


FOLDED = f"{ORDERS}, folded AS ({dealt('y', 'o_orderkey', 'base')})"
