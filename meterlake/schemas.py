"""Schemas and fixed values of the meter data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for results to
# match, so they are stated plainly here and nowhere else.
# ---------------------------------------------------------------------------
GRID_ZONES = ["NRW-North", "NRW-South", "Bavaria", "Saxony", "Hamburg"]
METER_TYPES = ["residential", "commercial", "industrial"]
ZONE_NAMES = {
    "NRW-North": "North Rhine-Westphalia North",
    "NRW-South": "North Rhine-Westphalia South",
    "Bavaria": "Bavaria",
    "Saxony": "Saxony",
    "Hamburg": "Hamburg",
}
ZONE_STATES = {
    "NRW-North": "NRW",
    "NRW-South": "NRW",
    "Bavaria": "Bavaria",
    "Saxony": "Saxony",
    "Hamburg": "Hamburg",
}
# Day names by day-of-week number, 0 = Sunday.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
ALERT_TYPE = "CONSUMPTION_SPIKE"
# Validation bounds (inclusive): kwh >= 0, voltage in [200, 260], frequency in [49, 51].
MIN_KWH = 0
VOLTAGE_RANGE = (200, 260)
FREQUENCY_RANGE = (49, 51)
# Gold aggregation: tumbling window and allowed lateness.
GOLD_WINDOW = "5 minutes"
GOLD_WATERMARK = "2 minutes"
# Surrogate-key text: NULL marker and separator of the public dbt-utils macro,
# and the warehouse's default timestamp text.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
SURROGATE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
# Default names of the log topics.
READINGS_TOPIC = "raw-meter-readings"
ALERTS_TOPIC = "anomaly-alerts"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
READING_SCHEMA = T.StructType(
    [
        T.StructField("meter_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("kwh_reading", T.DoubleType()),
        T.StructField("voltage", T.DoubleType()),
        T.StructField("frequency", T.DoubleType()),
        T.StructField("grid_zone", T.StringType()),
        T.StructField("meter_type", T.StringType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("meter_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("kwh", T.DoubleType()),
        T.StructField("grid_zone", T.StringType()),
        T.StructField("alert_type", T.StringType()),
    ]
)

# The record layout of Spark's Kafka source.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

BRONZE_COLUMNS = [f.name for f in READING_SCHEMA.fields] + [
    "kafka_ts",
    "event_timestamp",
    "ingest_timestamp",
]
SILVER_COLUMNS = BRONZE_COLUMNS + ["is_valid", "processed_timestamp"]

# Warehouse load table: 13 typed columns, zone-less timestamps.
LOAD_TABLE_DDL = """
    METER_ID STRING,
    TIMESTAMP STRING,
    KWH_READING DOUBLE,
    VOLTAGE DOUBLE,
    FREQUENCY DOUBLE,
    GRID_ZONE STRING,
    METER_TYPE STRING,
    IS_ANOMALY BOOLEAN,
    KAFKA_TS TIMESTAMP_NTZ,
    EVENT_TIMESTAMP TIMESTAMP_NTZ,
    INGEST_TIMESTAMP TIMESTAMP_NTZ,
    IS_VALID BOOLEAN,
    PROCESSED_TIMESTAMP TIMESTAMP_NTZ
"""

STAGING_COLUMNS = [
    "meter_id",
    "event_timestamp",
    "kwh_reading",
    "voltage",
    "frequency",
    "grid_zone",
    "meter_type",
    "is_anomaly",
    "ingest_timestamp",
    "processed_timestamp",
]

GOLD_COLUMNS = [
    "window_start",
    "window_end",
    "grid_zone",
    "meter_type",
    "avg_kwh",
    "max_kwh",
    "total_kwh",
    "meter_count",
    "anomaly_count",
    "avg_voltage",
    "avg_frequency",
]

HOURLY_COLUMNS = [
    "meter_id",
    "grid_zone",
    "meter_type",
    "consumption_hour",
    "total_kwh",
    "avg_kwh",
    "max_kwh",
    "reading_count",
    "anomaly_count",
]
FACT_COLUMNS = [
    "consumption_id",
    "meter_id",
    "consumption_hour",
    "grid_zone",
    "meter_type",
    "total_kwh",
    "avg_kwh",
    "max_kwh",
    "reading_count",
    "anomaly_count",
]
