"""Calendar expressions for the date dimension and hourly grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import DAY_NAMES


def truncate_like(df: DataFrame, unit: str, column: str) -> Column:
    """``date_trunc`` that keeps the input's timestamp flavour.

    ``date_trunc`` on TIMESTAMP_NTZ returns TIMESTAMP; cast back so zone-less
    data stays zone-less.
    """
    out = F.date_trunc(unit, F.col(column))
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        out = out.cast(T.TimestampNTZType())
    return out


def day_of_week(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1


def day_name(ts: Column) -> Column:
    """English day name from the fixed list; NULL time gives NULL (said apart:
    an element of a constant array is never NULL to the code generator)."""
    return F.when(ts.isNotNull(), F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.dayofweek(ts)))
