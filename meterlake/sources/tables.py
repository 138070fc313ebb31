"""Batch reads of layer tables and declared source tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Read a layer written by a stream sink or a batch job.

    For a file-sink directory Spark reads through the sink's commit log, so
    files of failed or uncommitted batches are never seen. ``merge_schema``
    reconciles files written before and after a column was added.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_parquet_dir(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Recursive read of a (possibly zone-partitioned) parquet directory.

    Partition columns are discovered from ``key=value`` folders. A missing
    path raises PATH_NOT_FOUND and a folder without data files raises
    UNABLE_TO_INFER_SCHEMA, so a load job never silently loads nothing; the
    check costs no extra listing on the driver.
    """
    return read_layer(spark, path, "parquet", merge_schema)


def read_written(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A layer that a stream may not have written to yet: with its schema given,
    a folder without rows (or none at all) is an empty layer."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def dealt_evenly(rows: DataFrame) -> DataFrame:
    """The rows, dealt by their values over all cores of the cluster.

    A scan can't split a row group: without this, costly work on each row of a
    table in few row groups runs in as few tasks. The number of tasks is given,
    as small rows may grow under that work, and grows with the scan's."""
    tasks = max(_TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions())
    return rows.repartition(tasks, *rows.columns)


_TASKS_PER_CORE = 2


def source_table(spark: SparkSession, name: str) -> DataFrame:
    """A declared source: a catalog table or a temp view of that name, with
    lower-case column names (the load job's tables have upper-case ones)."""
    table = spark.table(name)
    return table.toDF(*[c.lower() for c in table.columns])
