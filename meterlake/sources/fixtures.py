"""Adapter from the generated ``events`` table to meter readings.

The generated test data holds no meter readings, so every row of ``events``
is mapped, deterministically and one-to-one, onto a reading in the shape of
the warehouse source table. The mapping (which rows get NULLs, bound values
or anomalies) is the shared test fixture; the oracle SQL uses the same text.
No row is dropped or sampled here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.config import ensure_utc
from meterlake.sources.tables import dealt_evenly

# "dense" squeezes the 30 days of test data into 12 hours so that 5-minute
# windows hold several readings.
_DENSE_TS = (
    "cast(timestamp_micros(unix_micros(timestamp'2024-01-01 00:00:00') + "
    "(unix_micros(cast(ts as timestamp)) - unix_micros(timestamp'2024-01-01 00:00:00')) div 60)"
    " as timestamp_ntz)"
)


_USED = ["event_id", "ts", "user_id", "value"]  # what the mapping reads
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generated ``events`` table, with its known schema (no footer
    inference on the driver)."""
    ensure_utc(spark)
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _event_time(variant: str) -> str:
    if variant == "native":
        return "ts"
    if variant == "dense":
        return _DENSE_TS
    if variant == "edge":
        return _EDGE_TS
    raise ValueError(f"unknown variant {variant!r}")


# The "edge" variant: some readings have no time, a zone or type the models do
# not know, or a voltage that is not a number. One row in, one row out.
_EDGE_TS = "case when event_id % 61 = 0 then cast(null as timestamp_ntz) else ts end"

# The zone of a meter: fixed per meter, or (variant "zone_flip") moved to the
# next zone for readings in the second half of each hour, so that meters
# change zone inside an hour.
_ZONE_KEY = {
    "fixed": "user_id",
    "edge": "user_id",
    "zone_flip": "(user_id + case when minute({ts}) >= 30 then 1 else 0 end)",
}


HOT_METER = "case when event_id % 3 = 0 then 7 else user_id end"


def _adapter_columns(ts: str, zone: str = "fixed", meter: str = "user_id") -> list[str]:
    # The fixture mapping, written once as SQL expressions (the same text the
    # oracle uses); Spark parses it on the JVM side in one call.
    odd_zone = "when event_id % 59 = 0 then 'NRW-East' when event_id % 53 = 0 then 'Atlantis' " if zone == "edge" else ""
    odd_type = "when event_id % 47 = 0 then 'unmetered' " if zone == "edge" else ""
    odd_voltage = "when event_id % 43 = 0 then cast('NaN' as double) " if zone == "edge" else ""
    return [
        f"""case when event_id % 103 = 0 then null
                else concat('METER-', lpad(cast({meter} as string), 4, '0')) end as meter_id""",
        f"{ts} as event_timestamp",
        """case when event_id % 97 = 0 then null
                when event_id % 89 = 0 then -1.5e0
                when event_id % 50 = 0 then value * 3
                else value end as kwh_reading""",
        f"""case when event_id % 101 = 0 then null
                {odd_voltage}when event_id % 83 = 0 then 190.0e0
                when event_id % 84 = 0 then 200.0e0
                when event_id % 86 = 0 then 260.0e0
                else 218 + cast(event_id % 241 as double) / 10 end as voltage""",
        """case when event_id % 79 = 0 then 51.5e0
                when event_id % 78 = 0 then 49.0e0
                else 49.8e0 + cast(event_id % 41 as double) / 100 end as frequency""",
        f"""case {odd_zone}else case {_ZONE_KEY[zone].format(ts=ts)} % 5 when 0 then 'NRW-North' when 1 then 'NRW-South'
                 when 2 then 'Bavaria' when 3 then 'Saxony' else 'Hamburg' end end as grid_zone""" if odd_zone else
        f"""case {_ZONE_KEY[zone].format(ts=ts)} % 5 when 0 then 'NRW-North' when 1 then 'NRW-South'
                 when 2 then 'Bavaria' when 3 then 'Saxony' else 'Hamburg' end as grid_zone""",
        f"""case {odd_type}else case user_id % 3 when 0 then 'residential' when 1 then 'commercial'
                            else 'industrial' end end as meter_type""" if odd_type else
        """case user_id % 3 when 0 then 'residential' when 1 then 'commercial'
                            else 'industrial' end as meter_type""",
        "case when event_id % 71 = 0 then null else event_id % 50 = 0 end as is_anomaly",
        f"{ts} + interval 2 seconds as ingest_timestamp",
        f"{ts} + interval 4 seconds as processed_timestamp",
    ]


def readings_from_events(events: DataFrame, variant: str = "native") -> DataFrame:
    """Variants: "native" and "dense" (time scale), "zone_flip" (native time,
    meters change zone at half past each hour), "edge" (missing times, unknown
    zones and types, a voltage that is not a number), "hot_meter" (one meter
    sends a third of all readings)."""
    if variant == "edge":
        return events.selectExpr(*_adapter_columns(_event_time("edge"), "edge"))
    if variant == "hot_meter":
        return events.selectExpr(*_adapter_columns(_event_time("native"), meter=HOT_METER))
    if variant == "zone_flip":
        return events.selectExpr(*_adapter_columns(_event_time("native"), "zone_flip"))
    return events.selectExpr(*_adapter_columns(_event_time(variant)))


def meter_readings(spark: SparkSession, sf_dir: str, variant: str = "native", even: bool = False) -> DataFrame:
    """Raw meter readings (the warehouse source table) for a test scale.

    With ``even`` the rows read are dealt over all cores first, whatever the
    table's row groups: for work that is costly per reading, like its JSON."""
    events = load_events(spark, sf_dir)
    return readings_from_events(dealt_evenly(events.select(*_USED)) if even else events, variant)


def stream_meter_readings(
    spark: SparkSession, sf_dir: str, variant: str = "native", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same readings as a stream over the ``events`` table file."""
    ensure_utc(spark)
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return readings_from_events(reader.parquet(sf_dir.rstrip("/")), variant)
