"""Gapless numbers for rows, without sorting them in one place.

Rows of a written table are numbered within their scan partitions (ranges of
files); the partitions' sizes are added up, one small row per partition, and
every row adds what lies before its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL = 33  # bits of monotonically_increasing_id that count within a partition


def with_local_number(df: DataFrame, name: str = "local_number") -> DataFrame:
    """Rows with the partition they are computed in and their place there, as one
    number. Write the result before ``gapless`` reads it: a plan that is run
    again may deal its rows otherwise."""
    return df.withColumn(name, F.monotonically_increasing_id())


def gapless(written: DataFrame, start: int | Column = 0, group: list[str] | None = None, local: str = "local_number", name: str = "number") -> DataFrame:
    """Replace the local number by gapless ones from ``start``, per ``group``.

    One row per partition (and group) is shuffled for the sums before it; with
    groups the places within a partition are counted by a window over
    (group, partition), so no group lands whole in one task."""
    group = group or []
    part = F.shiftright(local, _LOCAL).alias("__part")
    rows = written.withColumn("__part", part)
    if group:
        rows = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*group, "__part").orderBy(local)) - 1)
    else:
        rows = rows.withColumn("__at", F.col(local).bitwiseAND((1 << _LOCAL) - 1))
    sizes = written.select(*group, part).groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(g).alias(f"__g_{g}") for g in group], F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    same = F.col("__part") == F.col("__p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    first = F.lit(start) if isinstance(start, int) else start
    out = rows.join(offsets, same).withColumn(name, (first + F.col("__before") + F.col("__at")).cast("bigint"))
    return out.select(*[c for c in written.columns if c != local], name)
