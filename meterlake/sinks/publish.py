"""Publish keyed JSON messages to a log topic or to envelope files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.schemas import READINGS_TOPIC
from meterlake.sources.log import envelope_from_messages


def publish_messages(
    messages: DataFrame,
    target: str,
    topic: str = READINGS_TOPIC,
    brokers: str | None = None,
    log_time: Column | None = None,
) -> None:
    """Write (key, value) messages.

    With ``brokers`` they go to the topic through Spark's Kafka sink (needs
    the connector); otherwise they are appended as envelope parquet files
    under ``target``, which ``read_envelope_files`` replays as a stream.
    """
    if brokers:
        (
            messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("topic", topic)
            .save()
        )
        return
    envelope = envelope_from_messages(messages, log_time if log_time is not None else F.current_timestamp(), topic)
    envelope.write.mode("append").parquet(target)


def write_envelope_files(envelope: DataFrame, path: str) -> str:
    """Write log records as several files, like the partitions of a topic.

    Rows are spread round-robin, not by key: a meter holding a third of the
    readings must not make one log partition (and its bronze task) hot.
    """
    parts = envelope.sparkSession.sparkContext.defaultParallelism
    envelope.repartition(parts).write.mode("overwrite").parquet(path)
    return path
