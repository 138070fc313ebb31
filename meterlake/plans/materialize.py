"""Materialisations: view, table (full rebuild) and incremental fact.

Tables are parquet folders (a catalog table name can be registered over
them). The fact is partitioned by the date of its hour so the high-water
mark lookup and later reads touch few files per day of data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.config import ensure_checkpoint_dir
from meterlake.operators import marts
from meterlake.schemas import FACT_COLUMNS

FACT_PARTITION = "consumption_date"


def as_view(df: DataFrame, name: str) -> DataFrame:
    """``view`` materialisation: a named, lazily recomputed plan."""
    df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """``table`` materialisation: full rebuild by overwrite, then read back."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    writer.save(path)
    return df.sparkSession.read.format(fmt).load(path)


def with_partition(fact: DataFrame) -> DataFrame:
    return fact.withColumn(FACT_PARTITION, F.to_date("consumption_hour"))


def read_fact(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).select(*FACT_COLUMNS)


@dataclass
class RunResult:
    mode: str  # "full", "incremental" or "skipped"
    high_water_mark: str | None


def typed_literal(text: str, like: DataFrame, column: str) -> Column:
    # Through text so the value round-trips exactly in the session time zone.
    return F.lit(text).cast(like.schema[column].dataType)


def high_water_mark(target: DataFrame, column: str = "consumption_hour") -> str | None:
    """Max of ``column`` as text (a single scalar reaches the driver).

    When the target carries the date partition column, the newest date is
    found from partition values first (file footers only, no column data)
    and the hour column is then read inside that one partition only, instead
    of across the table's whole history.
    """
    if FACT_PARTITION in target.columns:
        last_day = target.select(F.max(FACT_PARTITION).cast("string")).first()[0]
        if last_day is None:
            return None
        target = target.where(F.col(FACT_PARTITION) == F.lit(last_day).cast("date"))
    return target.select(F.max(column).cast("string")).first()[0]


def _existing(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The target read with the expected schema, or None if the path is
    absent. An explicit schema keeps an existing but empty table (a
    partitioned write of no rows leaves no data file) distinct from a
    missing one."""
    try:
        return spark.read.schema(schema).parquet(path).select(*FACT_COLUMNS, FACT_PARTITION)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise  # an unreadable target must not be taken for a missing one and overwritten
        return None


def incremental_fact(
    spark: SparkSession,
    staged: DataFrame,
    target_path: str,
    full_refresh: bool = False,
    hourly: DataFrame | None = None,
) -> RunResult:
    """Build or extend the hourly fact at ``target_path``.

    * target absent, or ``full_refresh``: full build (overwrite).
    * otherwise only hours strictly after the target's max hour are
      appended. Rows arriving later for that newest (possibly half-full)
      hour or older hours are ignored, NULL hours enter on the first run
      only, and an existing but empty target receives nothing (its max is
      NULL). With the strict ``>`` no new key can equal an old one, so the
      unique-key merge reduces to an append.

    The cut is also applied to the readings as
    ``event_timestamp >= date_trunc('hour', max) + 1 hour`` (implied by the
    hour predicate), which reaches the scan as a pushed filter, so an
    incremental run reads only new data. A caller that already holds the
    hourly aggregate of all readings passes it as ``hourly``; new hours are
    then selected from it instead.
    """
    full = with_partition(marts.fact_consumption(hourly if hourly is not None else marts.hourly_consumption(staged)))
    target = None if full_refresh else _existing(spark, target_path, full.schema)
    if target is None:
        _write_fact(full, target_path, "overwrite")
        return RunResult("full", None)
    mark = high_water_mark(target)
    if mark is None:
        return RunResult("skipped", None)
    mark_hour = typed_literal(mark, target, "consumption_hour")
    if hourly is None:
        cut = F.date_trunc("hour", mark_hour).cast(staged.schema["event_timestamp"].dataType)
        new_rows = staged.where(F.col("event_timestamp") >= cut + F.expr("INTERVAL 1 HOUR"))
        hourly = marts.hourly_consumption(new_rows)
    fact = marts.fact_consumption(hourly).where(F.col("consumption_hour") > mark_hour)
    _write_fact(with_partition(fact), target_path, "append")
    return RunResult("incremental", mark)


def _write_fact(fact: DataFrame, path: str, mode: str) -> None:
    """Write by date partition. The rebalance hint lets AQE size the write
    tasks (splitting a hot day, merging small ones) so each date gets few,
    full files instead of one file per task and date. An overwrite is a
    full rebuild: static mode, so dates absent from the new data go too."""
    writer = fact.hint("rebalance", FACT_PARTITION).write.mode(mode).partitionBy(FACT_PARTITION)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    writer.parquet(path)


def merge_by_key(target: DataFrame, updates: DataFrame, key: str = "consumption_id") -> DataFrame:
    """Upsert semantics: rows of ``target`` whose key is not updated, plus all
    updates."""
    return target.join(updates.select(key), key, "left_anti").unionByName(updates)


def upsert_fact(spark: SparkSession, target_path: str, updates: DataFrame, key: str = "consumption_id") -> None:
    """Upsert fact rows by key, rewriting only the date partitions touched.

    The target is restricted to the partitions of the updates (a semi join
    on the partition column, pruned at run time), merged, checkpointed into
    the shared checkpoint folder (so the write does not read the files it
    replaces) and written with dynamic partition overwrite.
    """
    ensure_checkpoint_dir(spark)
    updates = with_partition(updates.select(*FACT_COLUMNS))
    # One row per calendar date the updates touch (a century is 36,525 rows
    # of 4 bytes): a proven bound, so it is broadcast and a hot day of the
    # target is never shuffled into one task; it also drives partition
    # pruning of the target scan. NULL hours live in the NULL date, which the
    # overwrite replaces like any other, so it must match itself here.
    touched = updates.select(F.col(FACT_PARTITION).alias("touched_date")).distinct()
    target = spark.read.schema(updates.schema).parquet(target_path)
    existing = target.join(F.broadcast(touched), F.col(FACT_PARTITION).eqNullSafe(F.col("touched_date")), "left_semi")
    merged = merge_by_key(existing.select(*updates.columns), updates, key).checkpoint()
    (
        merged.hint("rebalance", FACT_PARTITION).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(FACT_PARTITION)
        .parquet(target_path)
    )
