"""Bronze, silver and staging layers, alerts and outgoing messages.

All functions are pure DataFrame transformations and work unchanged on a
streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.text import iso_utc_text
from meterlake.functions.validation import valid_reading
from meterlake.schemas import ALERT_SCHEMA, ALERT_TYPE, READING_SCHEMA, STAGING_COLUMNS

# A clock gives the processing-time stamp of a layer. The default is
# ``current_timestamp()`` (one value per query / micro-batch); tests inject a
# deterministic column expression instead.
Clock = Callable[[], Column] | None


def _now(clock: Clock) -> Column:
    return clock() if clock is not None else F.current_timestamp()


def parse_envelope(
    envelope: DataFrame, clock: Clock = None, log_time_col: str = "kafka_ts", schema: T.StructType = READING_SCHEMA
) -> DataFrame:
    """Bronze: JSON payload -> typed reading columns, plus log and ingest time.

    Malformed, empty or NULL payloads give an all-NULL reading (kept; silver
    drops it). A wrong-typed field nulls only that field; unknown fields are
    ignored. An unparseable timestamp text gives NULL instead of failing.
    ``schema`` is the reading's: a later generation may add fields, which then
    enter bronze (read a mixed table with ``read_layer(merge_schema=True)``).

    The struct is expanded with ``inline`` so the JSON text is parsed exactly
    once per record: expanding it with ``data.*`` would let the optimizer
    push each later filter below the expansion and re-parse per predicate.
    """
    parsed = envelope.select(
        F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))),
        F.col("timestamp").alias(log_time_col),
    )
    return parsed.withColumn("event_timestamp", F.try_to_timestamp(F.col("timestamp"))).withColumn(
        "ingest_timestamp", _now(clock)
    )


def silver(bronze: DataFrame, clock: Clock = None) -> DataFrame:
    """Validated readings: invalid rows are dropped, never flagged."""
    return (
        bronze.where(valid_reading())
        .withColumn("is_valid", F.lit(True))
        .withColumn("processed_timestamp", _now(clock))
    )


def staging(source: DataFrame) -> DataFrame:
    """Warehouse staging view: the same validation, ten columns."""
    return source.where(valid_reading()).select(*STAGING_COLUMNS)


def anomaly_alerts(staged: DataFrame) -> DataFrame:
    """Validated readings flagged as anomalies (NULL flag is not an alert)."""
    return staged.where(F.col("is_anomaly")).select(
        "meter_id", "event_timestamp", "kwh_reading", "grid_zone", "meter_type", "ingest_timestamp"
    )


def with_reading_text(readings: DataFrame) -> DataFrame:
    """Add the reading's ``timestamp`` text if it only has the parsed time."""
    if "timestamp" in readings.columns:
        return readings
    return readings.withColumn("timestamp", iso_utc_text(F.col("event_timestamp")))


def alert_messages(readings: DataFrame) -> DataFrame:
    """Producer-side alert for every anomalous raw reading (5 fields)."""
    return with_reading_text(readings).where(F.col("is_anomaly")).select(
        "meter_id",
        "timestamp",
        F.col("kwh_reading").alias("kwh"),
        "grid_zone",
        F.lit(ALERT_TYPE).alias("alert_type"),
    )


def alert_log_messages(readings_df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Alerts as (key, value) messages for the alerts topic; ``keep`` passes
    further columns of the readings through."""
    fields = [f.name for f in ALERT_SCHEMA.fields]
    alerts = with_reading_text(readings_df).where(F.col("is_anomaly")).withColumns(
        {"kwh": F.col("kwh_reading"), "alert_type": F.lit(ALERT_TYPE)}
    )
    return keyed_messages(alerts, fields=fields, keep=keep)


def keyed_messages(
    rows: DataFrame, fields: list[str] | None = None, key: str = "meter_id", keep: list[str] | None = None
) -> DataFrame:
    """(key, value) messages: the key column and a JSON object of ``fields``.

    NULL fields are written as JSON ``null`` like a Python producer does.
    ``keep`` passes further columns through (e.g. a log time).
    """
    rows = with_reading_text(rows) if fields is None else rows
    fields = fields or [f.name for f in READING_SCHEMA.fields]
    return rows.select(
        F.col(key).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        *(keep or []),
    )
