"""Bronze, silver and gold as streaming queries.

Two layouts:

* ``chained`` (default): bronze parses the log once and writes its table;
  silver streams from the bronze table, gold from the silver table. Each
  JSON payload is parsed once and every hop is exactly-once through the
  file sink's commit log.
* ``fanout``: three independent queries over one source, each parsing the
  log itself and starting at its own offsets.

Micro-batch boundaries differ between the layouts (in ``chained`` gold
batches follow silver's commits), so with live triggers a row close to the
lateness bound may be counted in one layout and dropped in the other, as it
may between two runs of either; bounded runs over data already on the log
give the same result in both.

Gold keeps keyed window state bounded by the watermark and emits each
window once, when the watermark passes its end (append mode). Triggers:
``"availableNow"`` for bounded runs (stages run one after another so each
sees its upstream complete), a processing-time string such as
``"30 seconds"`` for live runs (all stages run concurrently), or ``None``.
"""

from __future__ import annotations

import contextlib
import threading
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from meterlake.operators import marts, readings, windows
from meterlake.operators.readings import Clock
from meterlake.schemas import ALERTS_TOPIC, GOLD_COLUMNS, GOLD_WATERMARK, GOLD_WINDOW, READING_SCHEMA
from meterlake.sources.log import envelope_from_messages
from meterlake.streaming.generations import SchemaGenerations

_TS = T.TimestampType()
BRONZE_SCHEMA = T.StructType(
    READING_SCHEMA.fields
    + [T.StructField("kafka_ts", _TS), T.StructField("event_timestamp", _TS), T.StructField("ingest_timestamp", _TS)]
)
GOLD_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in zip(
            GOLD_COLUMNS,
            [_TS, _TS, T.StringType(), T.StringType(), *[T.DoubleType()] * 3, T.LongType(), T.LongType(), *[T.DoubleType()] * 2],
            strict=True,
        )
    ]
)
SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields + [T.StructField("is_valid", T.BooleanType()), T.StructField("processed_timestamp", _TS)]
)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class LayerPaths:
    base: str

    def table(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}"

    def checkpoint(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/_checkpoints/{layer}"


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    trigger: str | None = "availableNow",
    query_name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a table folder with its own checkpoint.

    Without ``checkpoint``, the session's default location is used
    (``spark.sql.streaming.checkpointLocation``, a folder per query name)."""
    writer = df.writeStream.format(fmt).outputMode("append")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return with_trigger(writer, trigger).start(path)


def read_layer_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream the committed files of a table written by a file sink."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start_medallion(
    spark: SparkSession,
    envelope: DataFrame,
    paths: LayerPaths,
    mode: str = "chained",
    trigger: str | None = "availableNow",
    fmt: str = "parquet",
    bronze_clock: Clock = None,
    silver_clock: Clock = None,
    window: str = GOLD_WINDOW,
    watermark: str = GOLD_WATERMARK,
    min_batches_to_retain: int | None = None,
    gold_state_partitions: int | None = None,
    date_partitions: bool = False,
    state_store: str | None = None,
    max_files_per_trigger: int | None = 1000,
    schema: T.StructType | None = None,
) -> dict[str, StreamingQuery]:
    """Start (and for ``availableNow``, run to completion) the three layers.

    Bronze and silver are partitioned by zone on disk; gold is not.
    ``min_batches_to_retain`` sets how many batches of checkpoint metadata
    the queries keep (a session setting read when a query starts).

    ``gold_state_partitions`` fixes the width of gold's state store (it is
    recorded in the checkpoint at the first start and cannot change later).
    Gold keeps about zones x types x open windows keys whatever the input
    volume, since partial aggregation runs before the shuffle, so a narrow
    state store avoids committing hundreds of empty state partitions per
    micro-batch.

    ``state_store="rocksdb"`` keeps gold's window state in RocksDB on the
    executors' local disks (with changelog checkpointing) instead of the JVM
    heap; like the width, the provider is fixed at the first start.

    ``max_files_per_trigger`` bounds the micro-batches of the inner hops, so
    that silver and gold work off a backlog in pieces after an outage.

    ``date_partitions`` adds an ``event_date`` column and partitions bronze
    and silver by date, then zone. Five zone folders alone cannot prune a
    date-range read of a large table; with dates, backfills and batch reads
    of a period touch only that period's files. Rows without event time go
    to the default (NULL) date partition.

    ``schema`` is the reading's from this start on: a later generation may add
    fields, on the same checkpoints and tables. Without it the newest generation
    that the tables know is used (see ``generations``).
    """
    if min_batches_to_retain is not None:
        with _settings(spark, {"spark.sql.streaming.minBatchesToRetain": str(min_batches_to_retain)}):
            return start_medallion(
                spark, envelope, paths, mode, trigger, fmt, bronze_clock, silver_clock, window, watermark, None,
                gold_state_partitions, date_partitions, state_store, max_files_per_trigger, schema,
            )
    sequential = trigger in ("availableNow", "once")
    started: dict[str, StreamingQuery] = {}

    def start(name: str, df: DataFrame, partition_by: list[str] | None) -> None:
        q = write_stream(df, paths.table(name), paths.checkpoint(name), fmt, partition_by, trigger)
        started[name] = q
        if sequential:
            q.awaitTermination()

    def start_gold(df: DataFrame) -> None:
        settings: dict[str, str] = {}
        if gold_state_partitions is not None:
            settings["spark.sql.shuffle.partitions"] = str(gold_state_partitions)
        if state_store == "rocksdb":
            settings[_PROVIDER] = _ROCKSDB
            settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
        elif state_store is not None:
            raise ValueError(f"unknown state store {state_store!r}")
        with _settings(spark, settings):
            start("gold", df, None)

    layout = ["event_date", "grid_zone"] if date_partitions else ["grid_zone"]
    reading = SchemaGenerations(spark, paths.base).at_start(schema)
    bronze = readings.parse_envelope(envelope, bronze_clock, schema=reading)
    added = reading.fields[len(READING_SCHEMA.fields) :]
    if date_partitions:
        bronze = bronze.withColumn("event_date", F.to_date("event_timestamp"))
    if mode == "fanout":
        silver = readings.silver(bronze, silver_clock)
        start("bronze", bronze, layout)
        start("silver", silver, layout)
        start_gold(windows.gold(silver, window, watermark))
        return started
    if mode != "chained":
        raise ValueError(f"unknown mode {mode!r}")
    start("bronze", bronze, layout)
    extra = added + ([T.StructField("event_date", T.DateType())] if date_partitions else [])
    bronze_in = read_layer_stream(spark, paths.table("bronze"), T.StructType(BRONZE_SCHEMA.fields + extra), fmt, max_files_per_trigger)
    start("silver", readings.silver(bronze_in, silver_clock), layout)
    silver_in = read_layer_stream(spark, paths.table("silver"), T.StructType(SILVER_SCHEMA.fields + extra), fmt, max_files_per_trigger)
    start_gold(windows.gold(silver_in, window, watermark))
    return started


# What gold's aggregate keeps per key, in the order of its columns.
_STATE = (
    "struct<sum_kwh:double,count_kwh:bigint,max_kwh:double,total_kwh:double,meter_count:bigint,anomaly_count:bigint,"
    "sum_voltage:double,count_voltage:bigint,sum_frequency:double,count_frequency:bigint>"
)


def open_windows(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """Gold rows of the windows that the watermark has not closed, as they stand
    in gold's state store after its last batch (not while the query runs).

    Emitted and open windows together are the batch aggregate of the rows that
    were not late."""
    state = spark.read.format("statestore").load(paths.checkpoint("gold")).where(F.col("value").isNotNull())
    totals = state.select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        F.col("key.grid_zone").alias("grid_zone"), F.col("key.meter_type").alias("meter_type"), F.col("value").cast(_STATE).alias("v"),
    )
    return windows.gold_from_totals(totals.select(*totals.columns[:4], "v.*"))


def run_bounded(queries: dict[str, StreamingQuery], timeout_sec: float) -> None:
    """Wait for any of the started queries to end or for the timeout, then stop
    them; other queries of the session go on. If one of them failed, its error
    is raised (that of the first, in the order given)."""
    end = time.monotonic() + timeout_sec
    try:
        while all(q.isActive for q in queries.values()) and (left := end - time.monotonic()) > 0:
            time.sleep(min(_POLL_SEC, left))
    finally:
        for q in queries.values():
            q.stop()
    for q in queries.values():
        if (error := q.exception()) is not None:
            raise error


_POLL_SEC = 0.2


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that a query reads as it starts, put back afterwards."""
    with _SETTINGS_LOCK:  # concurrent starts must not see each other's settings
        previous = {key: spark.conf.get(key, None) for key in settings}
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in previous.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


_SETTINGS_LOCK = threading.RLock()


def publish_alerts(readings_stream: DataFrame, path: str, checkpoint: str | None = None, brokers: str | None = None,
                   topic: str = ALERTS_TOPIC, trigger: str | None = "availableNow", log_time: Column | None = None) -> StreamingQuery:
    """Alerts of a stream of readings as keyed messages on their own topic: to the
    log with ``brokers`` (needs the connector), else as envelope files."""
    messages = readings.alert_log_messages(readings_stream, keep=["event_timestamp"])
    if brokers:
        writer = messages.select("key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic)
        if checkpoint is not None:
            writer = writer.option("checkpointLocation", checkpoint)
        return with_trigger(writer, trigger).start()
    stamp = log_time if log_time is not None else F.current_timestamp()
    return write_stream(envelope_from_messages(messages, stamp, topic), path, checkpoint, trigger=trigger)


def update_meter_hours(silver: DataFrame, path: str, checkpoint: str | None = None, trigger: str | None = "availableNow") -> StreamingQuery:
    """Keep the meter x hour totals: each micro-batch of new silver rows adds its
    partial rows in a folder of its own. A batch that is run again replaces its
    folder, so each reading counts once. Read with ``read_meter_hours``."""

    def add(batch: DataFrame, number: int) -> None:
        marts.meter_hour_parts(batch).write.mode("overwrite").parquet(f"{path}/delivery={number}")

    writer = silver.writeStream.foreachBatch(add)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return with_trigger(writer, trigger).start()


def read_meter_hours(spark: SparkSession, path: str) -> DataFrame:
    return marts.merged_meter_hours(spark.read.parquet(path).drop("delivery"))
