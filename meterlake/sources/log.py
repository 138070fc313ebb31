"""The partitioned log of JSON readings.

Operators consume an *envelope* DataFrame with the Kafka source layout, so
the same code runs on a live broker, on Event Hubs' Kafka endpoint, or on
envelope files written by Spark (tests and replays).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.numbering import gapless, with_local_number
from meterlake.schemas import ENVELOPE_SCHEMA, READINGS_TOPIC


def read_log(
    spark: SparkSession,
    brokers: str,
    topic: str = READINGS_TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to one topic; needs the Kafka connector on the classpath.

    ``fail_on_data_loss=False`` keeps the stream running when retention has
    removed segments it had not read yet.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def from_event_hubs(df: DataFrame) -> DataFrame:
    """Map an Event Hubs record (``body``, ``enqueuedTime``) onto the envelope."""
    cols = set(df.columns)
    out = df
    if "body" in cols:
        out = out.withColumnRenamed("body", "value")
    if "enqueuedTime" in cols:
        out = out.withColumnRenamed("enqueuedTime", "timestamp")
    return out


def envelope_from_messages(
    messages: DataFrame,
    log_time: Column,
    topic: str = READINGS_TOPIC,
    partitions: int = 3,
    partition: Column | None = None,
) -> DataFrame:
    """Wrap (key, value) messages in the envelope layout.

    The log partition is a hash of the key, as a keyed producer would pick, or
    the given column. Offsets stay NULL until ``assign_offsets``.
    """
    number = partition if partition is not None else F.pmod(F.hash(F.col("key")), F.lit(partitions))
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        number.cast("int").alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        log_time.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def assign_offsets(envelope: DataFrame, scratch: str, start: int = 0) -> DataFrame:
    """Offsets from ``start`` without gaps in every log partition, in the order of
    log time (then key and value).

    Nothing is sorted in one place: rows are dealt by ranges of that order and
    sorted within them; a range's rows of each log partition are counted, and
    the counts before a range are added to the places within it. ``scratch`` is
    a new folder for the dealt rows, so that a task run again numbers alike."""
    order = ["timestamp", "key", "value"]
    ranged = envelope.drop("offset").repartitionByRange(*order).sortWithinPartitions(*order)
    with_local_number(ranged).write.parquet(scratch)
    spark = envelope.sparkSession
    dealt = spark.read.schema(T.StructType([*ranged.schema.fields, T.StructField("local_number", T.LongType())])).parquet(scratch)
    return gapless(dealt, start, group=["partition"], name="offset").select(*ENVELOPE_SCHEMA.fieldNames())


def from_offsets(envelope: DataFrame, offsets: dict[int, int], others: str = "earliest") -> DataFrame:
    """The records from the given offset of each log partition on (it included);
    of partitions not named all (``earliest``) or none (``latest``). As plain
    comparisons the offsets reach the scan of envelope files."""
    if others not in ("earliest", "latest"):
        raise ValueError(f"unknown start {others!r}")
    named = F.col("partition").isin(*offsets) if offsets else F.lit(False)
    wanted = ~named if others == "earliest" else F.lit(False)
    for number, first in offsets.items():
        wanted = wanted | ((F.col("partition") == number) & (F.col("offset") >= first))
    return envelope.where(wanted)


def read_envelope_files(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Envelope records stored as parquet, read as a stream or a batch."""
    if not stream:
        return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
