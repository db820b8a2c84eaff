"""Calendar features of a date or timestamp column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_of_week(t: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(t)


def cyclic(x: Column, period: int) -> tuple[Column, Column]:
    angle = x * F.lit(2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def micros(df: DataFrame, name: str) -> Column:
    """A long in the order of a time column: the instant, or the wall clock where there is no time zone."""
    kind, t = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(t)
    day = F.unix_date(F.to_date(t)).cast("long") * 86_400_000_000
    if isinstance(kind, T.DateType):
        return day
    clock = (F.hour(t) * 3600 + F.minute(t) * 60).cast("long") * 1_000_000
    return day + clock + F.round(F.date_part(F.lit("SECOND"), t).cast("double") * 1_000_000.0).cast("long")


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole days between two ``micros``, rounded down (not calendar days)."""
    return F.floor((later - earlier) / F.lit(86_400_000_000)).cast("long")


def calendar_columns(name: str) -> dict[str, Column]:
    t = F.col(name)
    month_sin, month_cos = cyclic(F.month(t), 12)
    dow_sin, dow_cos = cyclic(day_of_week(t), 7)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.day(t),
        "dayofweek": day_of_week(t),
        "dayofyear": F.dayofyear(t),
        "weekofyear": F.weekofyear(t),
        "quarter": F.quarter(t),
        "month_sin": month_sin,
        "month_cos": month_cos,
        "dayofweek_sin": dow_sin,
        "dayofweek_cos": dow_cos,
        "is_weekend": (day_of_week(t) >= 5).cast("int"),
        "is_month_start": (F.day(t) == 1).cast("int"),
        "is_month_end": (F.to_date(t) == F.last_day(t)).cast("int"),
    }


def add_calendar(df: DataFrame, name: str) -> DataFrame:
    """Add year .. is_month_end for a date, timestamp or parseable string column."""
    if df.schema[name].dataType.simpleString() == "string":
        df = df.withColumn(name, F.to_timestamp(name))
    return df.withColumns(calendar_columns(name))
