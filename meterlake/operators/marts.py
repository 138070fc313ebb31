"""Star schema: hourly consumption fact and meter / zone / date dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import day_name, day_of_week, truncate_like
from meterlake.functions.keys import surrogate_key
from meterlake.functions.zones import federal_state, zone_name
from meterlake.schemas import FACT_COLUMNS, HOURLY_COLUMNS


def hourly_consumption(staged: DataFrame) -> DataFrame:
    """Per meter x zone x type x hour totals (the intermediate view).

    Partial aggregation before the shuffle keeps a hot meter or zone from
    landing whole in one task.
    """
    hour = truncate_like(staged, "hour", "event_timestamp")
    return (
        staged.groupBy("meter_id", "grid_zone", "meter_type", hour.alias("consumption_hour"))
        .agg(
            F.sum("kwh_reading").alias("total_kwh"),
            F.avg("kwh_reading").alias("avg_kwh"),
            F.max("kwh_reading").alias("max_kwh"),
            F.count(F.lit(1)).alias("reading_count"),
            F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
        )
        .select(*HOURLY_COLUMNS)
    )


def fact_consumption(hourly: DataFrame) -> DataFrame:
    """Fact rows keyed by md5(meter_id, hour).

    The key covers meter and hour only while the grain also has zone and
    type: a meter that changes zone within an hour yields a duplicate key,
    which the uniqueness check reports.
    """
    key = surrogate_key(
        "meter_id",
        "consumption_hour",
        types=[None, hourly.schema["consumption_hour"].dataType],
    )
    return hourly.select(key.alias("consumption_id"), *FACT_COLUMNS[1:])


def dim_meters(staged: DataFrame) -> DataFrame:
    """One row per meter. Zone and type take the smallest value seen (a
    deterministic choice among the meter's values)."""
    return staged.groupBy("meter_id").agg(
        F.min("grid_zone").alias("grid_zone"),
        F.min("meter_type").alias("meter_type"),
        F.min("event_timestamp").alias("first_seen_at"),
        F.max("event_timestamp").alias("last_seen_at"),
        F.count(F.lit(1)).alias("total_readings"),
    )


def dim_grid_zones(staged: DataFrame) -> DataFrame:
    """One row per zone with its distinct meter count; names are mapped
    after the aggregate (they depend on the zone only)."""
    counts = staged.groupBy("grid_zone").agg(F.count_distinct("meter_id").alias("meter_count"))
    return counts.select(
        "grid_zone",
        zone_name("grid_zone").alias("grid_zone_name"),
        federal_state("grid_zone").alias("federal_state"),
        "meter_count",
    )


def dim_dates(staged: DataFrame) -> DataFrame:
    """Distinct hours with their calendar attributes.

    The hour determines every attribute, so only distinct hours are
    shuffled (at most one row per hour per task after the partial
    aggregate); the attributes are derived afterwards. A NULL event time
    gives one all-NULL row.
    """
    hours = staged.select(truncate_like(staged, "hour", "event_timestamp").alias("date_hour")).distinct()
    h = F.col("date_hour")
    return hours.select(
        F.to_date(h).alias("date_day"),
        h.alias("date_hour"),
        F.year(h).alias("year"),
        F.month(h).alias("month"),
        F.dayofmonth(h).alias("day"),
        F.hour(h).alias("hour"),
        day_of_week(h).alias("day_of_week"),
        day_name(h).alias("day_name"),
    )


# --- one-scan build ---------------------------------------------------------------
# The hourly grain carries everything the dimensions need, so a job that
# builds all marts reads the readings once: aggregate to meter x zone x
# type x hour (with first/last reading time), then derive the fact and the
# three dimensions from that much smaller intermediate.


def meter_hours(staged: DataFrame) -> DataFrame:
    hour = truncate_like(staged, "hour", "event_timestamp")
    return staged.groupBy("meter_id", "grid_zone", "meter_type", hour.alias("consumption_hour")).agg(
        F.sum("kwh_reading").alias("total_kwh"),
        F.avg("kwh_reading").alias("avg_kwh"),
        F.max("kwh_reading").alias("max_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
        F.min("event_timestamp").alias("first_reading_at"),
        F.max("event_timestamp").alias("last_reading_at"),
    )


def hourly_from_meter_hours(mh: DataFrame) -> DataFrame:
    return mh.select(*HOURLY_COLUMNS)


def dim_meters_from_meter_hours(mh: DataFrame) -> DataFrame:
    return mh.groupBy("meter_id").agg(
        F.min("grid_zone").alias("grid_zone"),
        F.min("meter_type").alias("meter_type"),
        F.min("first_reading_at").alias("first_seen_at"),
        F.max("last_reading_at").alias("last_seen_at"),
        F.sum("reading_count").alias("total_readings"),
    )


def dim_grid_zones_from_meter_hours(mh: DataFrame) -> DataFrame:
    return dim_grid_zones(mh)


def dim_dates_from_meter_hours(mh: DataFrame) -> DataFrame:
    hours = mh.select(F.col("consumption_hour").alias("event_timestamp"))
    return dim_dates(hours)


def from_meter_hours(mh: DataFrame) -> dict[str, DataFrame]:
    """All four marts from the meter x hour totals."""
    return {
        "fct_energy_consumption": fact_consumption(hourly_from_meter_hours(mh)),
        "dim_meters": dim_meters_from_meter_hours(mh),
        "dim_grid_zones": dim_grid_zones_from_meter_hours(mh),
        "dim_dates": dim_dates_from_meter_hours(mh),
    }


# --- incremental meter hours ---------------------------------------------------------
# Sums, counts, minima and maxima of parts merge into those of the whole, so
# the totals can be kept as one set of partial rows per delivery.


def meter_hour_parts(staged: DataFrame) -> DataFrame:
    """Mergeable totals of one delivery of readings (the average as sum and count)."""
    hour = truncate_like(staged, "hour", "event_timestamp")
    return staged.groupBy("meter_id", "grid_zone", "meter_type", hour.alias("consumption_hour")).agg(
        F.sum("kwh_reading").alias("total_kwh"),
        F.count("kwh_reading").alias("kwh_count"),
        F.max("kwh_reading").alias("max_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
        F.sum(F.when(F.col("is_anomaly"), 1).otherwise(0)).alias("anomaly_count"),
        F.min("event_timestamp").alias("first_reading_at"),
        F.max("event_timestamp").alias("last_reading_at"),
    )


def merged_meter_hours(parts: DataFrame) -> DataFrame:
    """``meter_hours`` of all deliveries from their partial rows."""
    return parts.groupBy("meter_id", "grid_zone", "meter_type", "consumption_hour").agg(
        F.sum("total_kwh").alias("total_kwh"),
        (F.sum("total_kwh") / F.sum("kwh_count")).alias("avg_kwh"),
        F.max("max_kwh").alias("max_kwh"),
        F.sum("reading_count").alias("reading_count"),
        F.sum("anomaly_count").alias("anomaly_count"),
        F.min("first_reading_at").alias("first_reading_at"),
        F.max("last_reading_at").alias("last_reading_at"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """One mergeable row per meter, zone, type and hour from those of several deliveries."""
    keys = ["meter_id", "grid_zone", "meter_type", "consumption_hour"]
    add = [F.sum(c).alias(c) for c in ("total_kwh", "kwh_count", "reading_count", "anomaly_count")]
    return parts.groupBy(*keys).agg(
        *add, F.max("max_kwh").alias("max_kwh"), F.min("first_reading_at").alias("first_reading_at"),
        F.max("last_reading_at").alias("last_reading_at"),
    ).select(*[c for c in parts.columns if c in keys or c in _PART_VALUES])


_PART_VALUES = ("total_kwh", "kwh_count", "max_kwh", "reading_count", "anomaly_count", "first_reading_at", "last_reading_at")


# --- dimensions that grow by deliveries ------------------------------------------------
# A dimension merges with that of a new delivery; nothing older is read again. For
# the distinct meters of a zone every meter has a number (from 1, without gaps), and
# a zone keeps one bit per meter: 4 KB for each 32,768 meters.


def merged_dim_meters(parts: DataFrame) -> DataFrame:
    """``dim_meters`` rows (with ``meter_number``) of several deliveries, merged."""
    return parts.groupBy("meter_id").agg(
        F.min("grid_zone").alias("grid_zone"),
        F.min("meter_type").alias("meter_type"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("total_readings").alias("total_readings"),
        F.max("meter_number").alias("meter_number"),
    )


def zone_bitmaps(zone_meters: DataFrame) -> DataFrame:
    """Per zone and bucket of meter numbers a bitmap of the meters seen there,
    from rows with ``grid_zone`` and ``meter_number``."""
    number = F.col("meter_number")
    return zone_meters.groupBy("grid_zone", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("meters")
    )


def merged_zone_bitmaps(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.groupBy("grid_zone", "bucket").agg(F.bitmap_or_agg("meters").alias("meters"))


def dim_grid_zones_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """The zone dimension with exact distinct meter counts, from merged bitmaps."""
    counts = bitmaps.groupBy("grid_zone").agg(F.sum(F.bitmap_count("meters")).alias("meter_count"))
    return counts.select(
        "grid_zone", zone_name("grid_zone").alias("grid_zone_name"), federal_state("grid_zone").alias("federal_state"), "meter_count"
    )
