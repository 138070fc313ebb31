"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import SURROGATE_NULL, SURROGATE_SEPARATOR, SURROGATE_TS_FORMAT


def _as_text(col: Column, dtype: T.DataType | None) -> Column:
    # Timestamps are rendered with milliseconds, as the warehouse prints them;
    # Spark's own cast to string would drop a zero fraction.
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, SURROGATE_TS_FORMAT)
    return col.cast("string")


def surrogate_key(*cols: Column | str, types: list[T.DataType | None] | None = None) -> Column:
    """md5 over the text of each column, NULLs replaced by a marker.

    ``concat`` (not ``concat_ws``) keeps NULL positions; the marker keeps the
    key defined when a part is NULL. Pass ``types`` for timestamp columns so
    they get the fixed text format.
    """
    types = types or [None] * len(cols)
    parts: list[Column] = []
    for i, (c, dtype) in enumerate(zip(cols, types)):
        c = F.col(c) if isinstance(c, str) else c
        if i:
            parts.append(F.lit(SURROGATE_SEPARATOR))
        parts.append(F.coalesce(_as_text(c, dtype), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat(*parts))
