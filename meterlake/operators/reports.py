"""Business reports over the star schema, previews and layer counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.zones import zones_in_state
from meterlake.operators.joins import skew_safe_join


def stable(x: Column | str, digits: int = 11) -> Column:
    """Round a double for ranking ties: sums depend on addition order in the
    last bits, so equal totals must compare equal before a tie-break. The
    first ``digits`` significant digits remain, whatever the size."""
    x = F.col(x) if isinstance(x, str) else x
    step = F.pow(F.lit(10.0), F.ceil(F.log10(F.abs(x))) - digits)
    return F.when(x == 0, x).otherwise(F.rint(x / step) * step)


def zone_hour_rank(fact: DataFrame, zones: DataFrame, state: str = "NRW", built_in_states: bool = False) -> DataFrame:
    """Zones of one federal state ranked by consumption within each hour.

    Which zones belong to the state is what ``zones`` says; a state that the
    dimension does not know gives no rows. The fact is summed per hour and
    zone (partially before its shuffle), so the join and the ranking see one
    row per hour and zone. The dimension has one row per zone and carries no
    broadcast hint: AQE broadcasts it once it has measured it.

    ``built_in_states`` says that the dimension was derived with the fixed
    zone mapping (``dim_grid_zones``). Only then the state implies the zones
    of that mapping, and the implied predicate is stated on the fact too, so
    it reaches the scan (or partition pruning).
    """
    if built_in_states:
        fact = fact.where(F.col("grid_zone").isin(zones_in_state(state)))
    in_state = zones.where(F.col("federal_state") == state).select("grid_zone", "grid_zone_name")
    per_zone = (
        fact.groupBy("consumption_hour", "grid_zone")
        .agg(F.sum("total_kwh").alias("total_kwh"), F.sum("reading_count").alias("reading_count"))
        .join(in_state, "grid_zone")
        .select("consumption_hour", "grid_zone", "grid_zone_name", "total_kwh", "reading_count")
    )
    order = Window.partitionBy("consumption_hour").orderBy(stable("total_kwh").desc(), F.col("grid_zone"))
    return per_zone.withColumn("zone_rank", F.row_number().over(order))


def spiking_meters(alerts: DataFrame, meters: DataFrame) -> DataFrame:
    """Meters with anomaly readings: how often and when, latest first.

    Alerts are reduced to one row per meter before the join, so a meter with
    a huge number of spikes adds one row to the join, not all of them.
    """
    per_meter = alerts.groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("spike_count"),
        F.min("event_timestamp").alias("first_spike_at"),
        F.max("event_timestamp").alias("last_spike_at"),
        F.max("kwh_reading").alias("max_spike_kwh"),
    )
    return per_meter.join(meters.select("meter_id", "grid_zone", "meter_type"), "meter_id").orderBy(
        F.col("last_spike_at").desc(), "meter_id"
    )


def spike_timeline(alerts: DataFrame, meters: DataFrame) -> DataFrame:
    """Every spike with its meter's attributes, in time order.

    All alert rows are joined to the meter dimension, so a meter with a
    very large share of the alerts would put that share in one join task.
    The join is therefore salted for meters above the mean task's share (see
    ``skew_safe_join``). The final order is a range-partitioned sort, whose
    sampled bounds also split a hot period.
    """
    m = meters.select("meter_id", "first_seen_at", "total_readings")
    return (
        skew_safe_join(alerts, m, "meter_id")
        .select(
            "event_timestamp",
            "meter_id",
            "grid_zone",
            "meter_type",
            F.col("kwh_reading").alias("spike_kwh"),
            "first_seen_at",
            "total_readings",
        )
        .orderBy("event_timestamp", "meter_id")
    )


def daily_peak_window(gold: DataFrame) -> DataFrame:
    """The window with the highest grid-wide consumption on each day.

    Ties go to the earlier window. Top-1 per day is an aggregate (max of a
    struct ordered by rounded total, then earlier start), so it is computed
    partially before the shuffle instead of sorting each day.
    """
    per_window = gold.groupBy("window_start", "window_end").agg(
        F.sum("total_kwh").alias("total_kwh"), F.sum("meter_count").alias("reading_count")
    )
    start_us = F.unix_micros(F.col("window_start").cast("timestamp"))
    best = per_window.groupBy(F.to_date("window_start").alias("day")).agg(
        F.max(
            F.struct(
                stable("total_kwh").alias("k"),
                (-start_us).alias("s"),
                "window_start",
                "window_end",
                "total_kwh",
                "reading_count",
            )
        ).alias("best")
    )
    return best.select("day", "best.window_start", "best.window_end", "best.total_kwh", "best.reading_count")


def consumption_by_type(fact: DataFrame) -> DataFrame:
    """Totals per meter type; the average is weighted by readings."""
    return fact.groupBy("meter_type").agg(
        F.sum("total_kwh").alias("total_kwh"),
        F.sum("reading_count").alias("reading_count"),
        (F.sum("total_kwh") / F.sum("reading_count")).alias("avg_kwh"),
        F.max("max_kwh").alias("max_kwh"),
        F.sum("anomaly_count").alias("anomaly_count"),
    )


def zone_anomaly_rate(fact: DataFrame) -> DataFrame:
    """Share of anomalous readings per zone and day."""
    return fact.groupBy("grid_zone", F.to_date("consumption_hour").alias("day")).agg(
        F.sum("reading_count").alias("reading_count"),
        F.sum("anomaly_count").alias("anomaly_count"),
        (F.sum("anomaly_count") / F.sum("reading_count")).alias("anomaly_rate"),
    )


def star_join(fact: DataFrame, meters: DataFrame, zones: DataFrame, dates: DataFrame) -> DataFrame:
    """The fact with attributes of all three dimensions.

    Zone and type come from the fact row (they are per hour). Join strategy
    is left to AQE, which broadcasts a dimension only after measuring it
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise
    keeps a shuffle join; the meter dimension grows with the fleet. Pass marts
    that were derived from one ``meter_hours`` table, so the readings behind
    them are read once.
    """
    m = meters.select("meter_id", "first_seen_at", "last_seen_at", "total_readings")
    z = zones.select("grid_zone", "grid_zone_name", "federal_state")
    d = dates.select(
        F.col("date_hour").alias("consumption_hour"), "date_day", "day_of_week", "day_name"
    )
    return fact.join(d, "consumption_hour").join(z, "grid_zone").join(m, "meter_id")


def gold_preview(gold: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` gold rows by window, zone and type (a top-k, not a sort)."""
    return gold.orderBy("window_start", "grid_zone", "meter_type").limit(n)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count per layer as one small DataFrame (layer, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count") for name, df in layers.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
