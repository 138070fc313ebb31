"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole test
tables (through the fixture adapter). Doubles are rounded on output with
``round(x + 1e-9, 6)`` so engines that add in another order agree; the
operators themselves return unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.config import at_session_end, shared_dir
from meterlake.functions.validation import rule_columns, valid_reading
from meterlake.operators import marts, quality, readings, reports, windows
from meterlake.plans import increments, job, materialize
from meterlake.plans.models import Models
from meterlake.schemas import BRONZE_COLUMNS, READING_SCHEMA, SILVER_COLUMNS
from meterlake.sinks import warehouse
from meterlake.sources.fixtures import meter_readings, stream_meter_readings
from meterlake.sources.log import assign_offsets, envelope_from_messages, from_event_hubs, from_offsets, read_envelope_files
from meterlake.sources.tables import read_layer, source_table
from meterlake.streaming import layers, one_parse
from meterlake.streaming.generations import SchemaGenerations

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, cols: list[str], digits: int = 6, eps: float = 1e-9) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + F.lit(eps), digits) for c in cols})


def _ntz(df: DataFrame) -> DataFrame:
    """Zone-less timestamps for comparison with a zone-less engine."""
    casts: dict[str, Column] = {
        f.name: F.col(f.name).cast(T.TimestampNTZType())
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df


def models(spark: SparkSession, sf_dir: str, variant: str = "native") -> Models:
    return Models(meter_readings(spark, sf_dir, variant))


_FACT_DOUBLES = ["total_kwh", "avg_kwh", "max_kwh"]
_GOLD_DOUBLES = ["avg_kwh", "max_kwh", "total_kwh", "avg_voltage", "avg_frequency"]


def staging_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).staging


def rejected_counts_by_rule(spark: SparkSession, sf_dir: str, variant: str = "native") -> DataFrame:
    """Rows failing each validation rule (NULL counts as failing), one pass."""
    raw = meter_readings(spark, sf_dir, variant)
    rules = dict(rule_columns())
    rules["all_rules"] = valid_reading()
    counts = raw.agg(
        *[F.sum(F.when(cond, 0).otherwise(1)).alias(name) for name, cond in rules.items()]
    )
    return counts.unpivot([], list(rules), "rule", "failed_rows")


def anomaly_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).alerts


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.alert_messages(meter_readings(spark, sf_dir))


def hourly_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(models(spark, sf_dir).hourly, _FACT_DOUBLES)


def fact_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(models(spark, sf_dir).fact, _FACT_DOUBLES)


def dim_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).dim_meters


def dim_grid_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).dim_grid_zones


def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).dim_dates


def _gold_batch(spark: SparkSession, sf_dir: str, variant: str = "dense") -> DataFrame:
    return windows.gold(models(spark, sf_dir, variant).staging, watermark=None)


def gold_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_gold_batch(spark, sf_dir), _GOLD_DOUBLES)


def gold_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reports.gold_preview(_gold_batch(spark, sf_dir)), _GOLD_DOUBLES)


def nrw_zone_hour_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return _round(reports.zone_hour_rank(m.fact, m.dim_grid_zones, "NRW", built_in_states=True), ["total_kwh"])


def spiking_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return _round(reports.spiking_meters(m.alerts, m.dim_meters), ["max_spike_kwh"])


def spike_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return reports.spike_timeline(m.alerts, m.dim_meters)


def daily_peak_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = windows.gold(models(spark, sf_dir, "native").staging, watermark=None)
    return _round(reports.daily_peak_window(gold), ["total_kwh"])


def consumption_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.consumption_by_type(models(spark, sf_dir).fact)
    out = _round(out, ["total_kwh"], 4, 1e-7)
    return _round(out, ["avg_kwh", "max_kwh"])


def zone_anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(reports.zone_anomaly_rate(models(spark, sf_dir).fact), ["anomaly_rate"])


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir).derived_once(shared_dir(spark, "meter_hours"))
    joined = reports.star_join(m["fct_energy_consumption"], m["dim_meters"], m["dim_grid_zones"], m["dim_dates"])
    return _round(joined, _FACT_DOUBLES)


def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.keyed_messages(meter_readings(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "staging_readings": staging_readings,
    "rejected_counts_by_rule": rejected_counts_by_rule,
    "anomaly_alerts": anomaly_alerts,
    "alert_messages": alert_messages,
    "hourly_consumption": hourly_consumption,
    "fact_consumption": fact_consumption,
    "dim_meters": dim_meters,
    "dim_grid_zones": dim_grid_zones,
    "dim_dates": dim_dates,
    "gold_5min": gold_5min,
    "gold_preview": gold_preview,
    "nrw_zone_hour_rank": nrw_zone_hour_rank,
    "spiking_meters": spiking_meters,
    "spike_timeline": spike_timeline,
    "daily_peak_window": daily_peak_window,
    "consumption_by_type": consumption_by_type,
    "zone_anomaly_rate": zone_anomaly_rate,
    "star_join": star_join,
    "keyed_messages": keyed_messages,
}


# --- incremental maintenance -------------------------------------------------

# A cut that splits an hour in half, so the incremental result differs from
# a full rebuild.
INCREMENTAL_CUT = "2024-01-15 12:30:00"


def fact_incremental_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run over readings before the cut, second run over all."""
    staged = models(spark, sf_dir).staging
    target = shared_dir(spark, "fact_incremental")
    cut = F.lit(INCREMENTAL_CUT).cast(staged.schema["event_timestamp"].dataType)
    materialize.incremental_fact(spark, staged.where(F.col("event_timestamp") < cut), target)
    materialize.incremental_fact(spark, staged, target)
    return _round(materialize.read_fact(spark, target), _FACT_DOUBLES)


def fact_upsert_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing fact (readings before the cut) upserted with the rebuilt
    hours from its newest hour on: the half-full hour's key is replaced."""
    staged = models(spark, sf_dir).staging
    target = shared_dir(spark, "fact_upsert")
    cut = F.lit(INCREMENTAL_CUT).cast(staged.schema["event_timestamp"].dataType)
    materialize.incremental_fact(spark, staged.where(F.col("event_timestamp") < cut), target)
    existing = spark.read.parquet(target)
    mark = materialize.typed_literal(materialize.high_water_mark(existing), existing, "consumption_hour")
    updates = marts.fact_consumption(marts.hourly_consumption(staged)).where(F.col("consumption_hour") >= mark)
    materialize.upsert_fact(spark, target, updates)
    return _round(materialize.read_fact(spark, target), _FACT_DOUBLES)


# --- data quality ---------------------------------------------------------------
def dq_source_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate({"meter_readings": meter_readings(spark, sf_dir)}, quality.SOURCE_SUITE)


def dq_mart_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over marts derived once, as in the job."""
    return quality.evaluate(models(spark, sf_dir).derived_once(shared_dir(spark, "meter_hours")), quality.MART_SUITE)


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_key_summary(models(spark, sf_dir).derived_once(shared_dir(spark, "meter_hours")), quality.MART_SUITE)


def dq_zone_change_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys the fact's uniqueness check reports when meters change zone
    inside an hour (the key covers meter and hour, the grain also zone)."""
    fact = models(spark, sf_dir, "zone_flip").fact
    return quality.failing_rows(fact, quality.Check("fct_energy_consumption", "consumption_id", "unique"))


def build_then_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialise all models, then report all 20 checks (report mode: the
    fixture's source holds NULL ids on purpose, so the gate would stop)."""
    out = shared_dir(spark, "models")
    result = job.run_then_test(spark, meter_readings(spark, sf_dir), out, fail_on_error=False)
    return result.checks


QUERIES.update(
    {
        "fact_incremental_two_runs": fact_incremental_two_runs,
        "fact_upsert_general": fact_upsert_general,
        "dq_source_suite": dq_source_suite,
        "dq_mart_suite": dq_mart_suite,
        "dq_duplicate_keys": dq_duplicate_keys,
        "dq_zone_change_duplicates": dq_zone_change_duplicates,
        "build_then_test": build_then_test,
    }
)


# --- log parsing, streaming layers, warehouse load --------------------------------


def _seconds(n: int) -> Column:
    return F.expr(f"INTERVAL {n} SECONDS")


# Deterministic processing-time stamps for comparable results: the log
# receives a reading 1 s after it was taken, bronze ingests it 1 s later and
# silver processes it 2 s after that (the fixture's ingest / processed times).
def _bronze_clock() -> Column:
    return F.col("kafka_ts") + _seconds(1)


def _silver_clock() -> Column:
    return F.col("kafka_ts") + _seconds(3)


def envelope_log(raw: DataFrame) -> DataFrame:
    """The readings as they would sit on the log: keyed JSON messages."""
    msgs = readings.keyed_messages(raw, keep=["event_timestamp"])
    return envelope_from_messages(msgs, F.col("event_timestamp").cast("timestamp") + _seconds(1))


def _bronze(spark: SparkSession, sf_dir: str, variant: str = "native") -> DataFrame:
    return readings.parse_envelope(envelope_log(meter_readings(spark, sf_dir, variant)), _bronze_clock)


def bronze_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_bronze(spark, sf_dir).select(*BRONZE_COLUMNS))


def silver_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(readings.silver(_bronze(spark, sf_dir), _silver_clock).select(*SILVER_COLUMNS))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer. Bronze is written once (each payload parsed once);
    silver and gold are derived from the bronze table, and each count reads
    only the columns it needs."""
    bronze = materialize.as_table(_bronze(spark, sf_dir, "dense"), shared_dir(spark, "bronze_layer"))
    silver = readings.silver(bronze, _silver_clock)
    gold = windows.gold(silver, watermark=None)
    return reports.layer_counts({"bronze": bronze, "silver": silver, "gold": gold})


# Gold state holds about zones x types x open windows keys at any input
# volume (the aggregate is partial before the shuffle), so a few state
# partitions suffice.
GOLD_STATE_PARTITIONS = 8


def _log_stream(spark: SparkSession, sf_dir: str, variant: str) -> DataFrame:
    """The readings as log records, streamed straight from the events table."""
    return envelope_log(stream_meter_readings(spark, sf_dir, variant))


def _run_medallion(spark: SparkSession, sf_dir: str, variant: str) -> layers.LayerPaths:
    paths = layers.LayerPaths(shared_dir(spark, "medallion"))
    layers.start_medallion(
        spark,
        _log_stream(spark, sf_dir, variant),
        paths,
        bronze_clock=_bronze_clock,
        silver_clock=_silver_clock,
        gold_state_partitions=GOLD_STATE_PARTITIONS,
    )
    return paths


def gold_5min_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-mode gold from a bounded streaming run over the log."""
    paths = _run_medallion(spark, sf_dir, "dense")
    return _ntz(_round(spark.read.parquet(paths.table("gold")), _GOLD_DOUBLES))


def gold_late_arrivals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-mode gold when part of the data arrives late.

    Every reading is delivered, in two bounded runs of the chained layers
    over a growing log: first the readings taken in even hours, then those
    of odd hours. A reading of the second run is dropped exactly when its
    window already closed under the watermark the first run left (max event
    time minus 2 minutes); the output holds the windows the final watermark
    has passed.
    """
    raw = meter_readings(spark, sf_dir, "dense", even=True)
    odd_hour = F.hour("event_timestamp") % 2 == 1
    log = shared_dir(spark, "late_log")
    paths = layers.LayerPaths(shared_dir(spark, "late_medallion"))
    for delivery in (raw.where(~odd_hour), raw.where(odd_hour)):
        envelope_log(delivery).write.mode("append").parquet(log)
        layers.start_medallion(
            spark,
            read_envelope_files(spark, log),
            paths,
            bronze_clock=_bronze_clock,
            silver_clock=_silver_clock,
            gold_state_partitions=GOLD_STATE_PARTITIONS,
        )
    return _ntz(_round(spark.read.parquet(paths.table("gold")), _GOLD_DOUBLES))


def bronze_by_zone_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written by the streaming query (zone-partitioned), read back."""
    paths = layers.LayerPaths(shared_dir(spark, "bronze_stream"))
    bronze = readings.parse_envelope(_log_stream(spark, sf_dir, "native"), _bronze_clock)
    layers.write_stream(bronze, paths.table("bronze"), paths.checkpoint("bronze"), partition_by=["grid_zone"]).awaitTermination()
    return _ntz(spark.read.parquet(paths.table("bronze")).select(*BRONZE_COLUMNS))


def load_silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver layer written zone-partitioned, then loaded into a new typed
    table through the load job."""
    silver_path = shared_dir(spark, "silver_layer")
    silver = readings.silver(_bronze(spark, sf_dir), _silver_clock)
    silver.write.mode("overwrite").partitionBy("grid_zone").parquet(silver_path)
    table = "meter_readings_" + silver_path.rstrip("/").rsplit("/", 1)[-1]
    result = warehouse.load_silver(spark, silver_path, table, shared_dir(spark, "warehouse"))
    at_session_end(spark, lambda: spark.sql(f"DROP TABLE IF EXISTS {result.table}"))
    return spark.table(result.table)


def alert_keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.alert_log_messages(meter_readings(spark, sf_dir))


QUERIES.update(
    {
        "alert_keyed_messages": alert_keyed_messages,
        "bronze_from_json": bronze_from_json,
        "silver_columns": silver_columns,
        "layer_counts": layer_counts,
        "gold_5min_stream": gold_5min_stream,
        "gold_late_arrivals_stream": gold_late_arrivals_stream,
        "bronze_by_zone_stream": bronze_by_zone_stream,
        "load_silver_table": load_silver_table,
    }
)


# --- unusual readings, skew, later deliveries --------------------------------------


def staging_readings_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir, "edge").staging


def rejected_counts_by_rule_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_counts_by_rule(spark, sf_dir, "edge")


def dim_grid_zones_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir, "edge").dim_grid_zones


def dim_dates_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a time give one row of NULLs."""
    return models(spark, sf_dir, "edge").dim_dates


def fact_consumption_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(models(spark, sf_dir, "edge").fact, _FACT_DOUBLES)


def gold_5min_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a time are in no window."""
    return _round(_gold_batch(spark, sf_dir, "edge"), _GOLD_DOUBLES)


def dq_source_suite_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate({"meter_readings": meter_readings(spark, sf_dir, "edge")}, quality.SOURCE_SUITE)


def dq_mart_suite_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(models(spark, sf_dir, "edge").derived_once(shared_dir(spark, "meter_hours")), quality.MART_SUITE)


def fact_upsert_null_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update of some of the keys whose hour is NULL keeps the others."""
    fact = models(spark, sf_dir, "edge").fact
    target = shared_dir(spark, "fact_null_hours")
    materialize.incremental_fact(spark, models(spark, sf_dir, "edge").staging, target)
    even = F.col("consumption_hour").isNull() & (F.substring("meter_id", 7, 4).cast("int") % 2 == 0)
    materialize.upsert_fact(spark, target, fact.where(even).withColumn("reading_count", F.col("reading_count") + 1))
    return _round(materialize.read_fact(spark, target), _FACT_DOUBLES)


def zone_rank_extended_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking follows a dimension that knows more zones than the mapping."""
    m = models(spark, sf_dir, "edge")
    state = F.when(F.col("grid_zone") == "NRW-East", "NRW").otherwise(F.col("federal_state"))
    zones = m.dim_grid_zones.withColumns({"federal_state": state, "grid_zone_name": F.coalesce("grid_zone_name", "grid_zone")})
    return _round(reports.zone_hour_rank(m.fact, zones, "NRW"), ["total_kwh"])


def spike_timeline_hot_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One meter sends a third of the readings: its alerts are salted in the join."""
    m = models(spark, sf_dir, "hot_meter")
    return reports.spike_timeline(m.alerts, m.dim_meters)


def gate_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gate decides on the whole job (the fixture fails it on purpose)."""
    return quality.outcome(build_then_test(spark, sf_dir))


def _malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze from a log on which some payloads are cut off."""
    log = envelope_log(meter_readings(spark, sf_dir))
    # The log time is one second after the reading's.
    bad = (F.unix_seconds(F.col("timestamp")) - 1) % 37 == 0
    cut = F.expr("cast(left(cast(value as string), 20) as binary)")
    return readings.parse_envelope(log.withColumn("value", F.when(bad, cut).otherwise(F.col("value"))), _bronze_clock)


def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_malformed(spark, sf_dir).select(*BRONZE_COLUMNS))


def silver_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(readings.silver(_malformed(spark, sf_dir), _silver_clock).select(*SILVER_COLUMNS))


_BUILT: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], object]):
    """What several queries of a session read is built by the first of them."""
    key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf_dir)
    return _BUILT[key]


def _delivered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, _meter_hours_of_two_deliveries)


def _meter_hours_of_two_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter x hour totals kept by a stream over silver, in two deliveries."""
    staged = models(spark, sf_dir).staging
    silver_path, path, checkpoint = (shared_dir(spark, x) for x in ("silver_feed", "meter_hours", "meter_hours_checkpoint"))
    odd_hour = F.hour("event_timestamp") % 2 == 1
    for delivery in (staged.where(~odd_hour), staged.where(odd_hour)):
        delivery.write.mode("append").parquet(silver_path)
        feed = layers.read_layer_stream(spark, silver_path, staged.schema)
        layers.update_meter_hours(feed, path, checkpoint).awaitTermination()
    return layers.read_meter_hours(spark, path)


def built_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(marts.from_meter_hours(_delivered_twice(spark, sf_dir))["fct_energy_consumption"], _FACT_DOUBLES)


def built_dim_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.from_meter_hours(_delivered_twice(spark, sf_dir))["dim_meters"]


def built_dim_grid_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.from_meter_hours(_delivered_twice(spark, sf_dir))["dim_grid_zones"]


def built_dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.from_meter_hours(_delivered_twice(spark, sf_dir))["dim_dates"]


def load_then_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job's table as the models' declared source."""
    silver_path = shared_dir(spark, "silver_layer")
    readings.silver(_bronze(spark, sf_dir), _silver_clock).write.mode("overwrite").partitionBy("grid_zone").parquet(silver_path)
    table = "meter_readings_" + silver_path.rstrip("/").rsplit("/", 1)[-1]
    warehouse.load_silver(spark, silver_path, table, shared_dir(spark, "warehouse"))
    at_session_end(spark, lambda: spark.sql(f"DROP TABLE IF EXISTS {table}"))
    out = reports.consumption_by_type(Models(source_table(spark, table)).fact)
    return _round(_round(out, ["total_kwh"], 4, 1e-7), ["avg_kwh", "max_kwh"])


def bronze_two_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of odd hours come with one field more; both generations are one table."""
    raw = meter_readings(spark, sf_dir, even=True)
    later = T.StructType([*READING_SCHEMA.fields, T.StructField("firmware", T.StringType())])
    path = shared_dir(spark, "bronze_generations")
    odd_hour = F.hour("event_timestamp") % 2 == 1
    generations = (
        (raw.where(~odd_hour), READING_SCHEMA),
        (raw.where(odd_hour).withColumn("firmware", F.concat(F.lit("fw-"), "meter_type")), later),
    )
    for rows, schema in generations:
        fields = [f.name for f in schema.fields]
        messages = readings.keyed_messages(readings.with_reading_text(rows), fields=fields, keep=["event_timestamp"])
        log = envelope_from_messages(messages, F.col("event_timestamp").cast("timestamp") + _seconds(1))
        readings.parse_envelope(log, _bronze_clock, schema=schema).write.mode("append").parquet(path)
    return _ntz(read_layer(spark, path, merge_schema=True).select(*BRONZE_COLUMNS, "firmware"))


def alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts published by a stream to their own topic (envelope files), read back."""
    path = shared_dir(spark, "alerts_topic")
    stream = stream_meter_readings(spark, sf_dir)
    stamp = F.col("event_timestamp").cast("timestamp") + _seconds(1)
    layers.publish_alerts(stream, path, shared_dir(spark, "alerts_checkpoint"), log_time=stamp).awaitTermination()
    out = read_envelope_files(spark, path, stream=False)
    return _ntz(out.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic", "timestamp"))


QUERIES.update(
    {
        f.__name__: f
        for f in (
            staging_readings_edge, rejected_counts_by_rule_edge, dim_grid_zones_edge, dim_dates_edge, fact_consumption_edge,
            gold_5min_edge, dq_source_suite_edge, dq_mart_suite_edge, fact_upsert_null_hours, zone_rank_extended_dimension,
            spike_timeline_hot_meter, gate_outcome, bronze_malformed, silver_malformed, built_fact, built_dim_meters,
            built_dim_grid_zones, built_dim_dates, load_then_models, bronze_two_schemas, alerts_stream,
        )
    }
)


# --- deliveries, publishing, one parse, offsets ---------------------------------------


def _delivered(spark: SparkSession, sf_dir: str) -> increments.Warehouse:
    """The warehouse after two deliveries: even hours, then odd ones."""
    source = meter_readings(spark, sf_dir, "edge")
    odd_hour = F.coalesce(F.hour("event_timestamp") % 2 == 1, F.lit(False))
    store = increments.Warehouse(spark, shared_dir(spark, "delivered"), late="merge")
    for name, rows in (("even", source.where(~odd_hour)), ("odd", source.where(odd_hour))):
        store.apply(rows, name, gate=False)
    return store


def delivered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_once(spark, sf_dir, _delivered).tables()[increments.FACT], _FACT_DOUBLES)


def delivered_dim_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, _delivered).tables()[increments.METERS]


def delivered_dim_grid_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, _delivered).tables()[increments.ZONES]


def delivered_dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, _delivered).tables()[increments.DATES]


def delivered_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 checks after the second delivery, from the results stored by part."""
    return _once(spark, sf_dir, _delivered).stored_checks()


def publish_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of the job by deliveries: a clean one, one that its gate stops
    (readings without a meter), the same delivery mended. What is published
    after each. A meter with two zones or types inside an hour has several fact
    rows with one key, in clean readings too: that check warns, it stops no run."""
    source = meter_readings(spark, sf_dir)
    clean = F.col("meter_id").isNotNull() & F.col("kwh_reading").isNotNull()
    cut = F.lit(PUBLISH_CUT).cast(source.schema["event_timestamp"].dataType)
    first, rest = F.col("event_timestamp") < cut, F.col("event_timestamp") >= cut
    out, seen = shared_dir(spark, "published"), []
    for step, (name, rows) in enumerate((("first", first & clean), ("rest", rest), ("rest", rest & clean)), 1):
        try:
            mode = job.run_then_test(spark, source.where(rows), out, delivery=name, warn=[increments.FACT_KEY]).fact_run.mode
        except quality.DataQualityError:
            mode = "stopped"
        tables = increments.Warehouse(spark, out).tables()
        seen.append(tables[increments.METERS].agg(F.sum("total_readings").alias("total_readings")).select(
            F.lit(step).alias("step"), F.lit(mode).alias("mode"), F.lit(tables[increments.FACT].count()).cast("bigint").alias("fact_rows"), "total_readings"))
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


PUBLISH_CUT = "2024-01-16 00:00:00"


def fact_upsert_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fact_upsert_general`` with the touched dates taken over by a new part."""
    source = meter_readings(spark, sf_dir)
    cut = F.lit(INCREMENTAL_CUT).cast(source.schema["event_timestamp"].dataType)
    store = increments.Warehouse(spark, shared_dir(spark, "upserted"))
    run = store.apply(source.where(F.col("event_timestamp") < cut), "first", gate=False)
    fact = Models(source).fact
    mark = materialize.typed_literal(store.manifest.current()[1]["mark"], fact, "consumption_hour")
    store.upsert(fact.where(F.col("consumption_hour") >= mark))
    assert run.published
    return _round(store.tables()[increments.FACT], _FACT_DOUBLES)


def _one_parse(spark: SparkSession, sf_dir: str) -> one_parse.OneParse:
    """The late arrivals of ``gold_late_arrivals_stream`` through the query that
    parses once; the layers are compacted between the runs and after them."""
    raw = meter_readings(spark, sf_dir, "dense", even=True)
    odd_hour = F.hour("event_timestamp") % 2 == 1
    log = shared_dir(spark, "one_parse_log")
    out = one_parse.OneParse(spark, shared_dir(spark, "one_parse"), _bronze_clock, _silver_clock, fan_in=2)
    for delivery in (raw.where(~odd_hour), raw.where(odd_hour)):
        envelope_log(delivery).write.mode("append").parquet(log)
        out.start(read_envelope_files(spark, log)).awaitTermination()
        out.compact()
    return out


def gold_all_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the chained layers' gold emitted, and those open in its state."""
    paths = _run_medallion(spark, sf_dir, "dense")
    return _ntz(_round(spark.read.parquet(paths.table("gold")).unionByName(layers.open_windows(spark, paths)), _GOLD_DOUBLES))


def one_parse_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_round(_once(spark, sf_dir, _one_parse).read("gold"), _GOLD_DOUBLES))


def one_parse_all_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emitted and open windows: the batch aggregate of all rows that were not late."""
    out = _once(spark, sf_dir, _one_parse)
    return _ntz(_round(out.read("gold").unionByName(out.open_windows()), _GOLD_DOUBLES))


def one_parse_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_once(spark, sf_dir, _one_parse).read("late").select(*SILVER_COLUMNS))


def one_parse_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_once(spark, sf_dir, _one_parse).read("silver").select(*SILVER_COLUMNS))


def bronze_two_schemas_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bronze_two_schemas`` through the streaming sink: the second run starts on
    the same checkpoint and table with the later generation of the schema."""
    raw = meter_readings(spark, sf_dir, even=True).withColumn("firmware", F.concat(F.lit("fw-"), "meter_type"))
    later = T.StructType([*READING_SCHEMA.fields, T.StructField("firmware", T.StringType())])
    log, paths = shared_dir(spark, "generations_log"), layers.LayerPaths(shared_dir(spark, "generations"))
    odd_hour = F.hour("event_timestamp") % 2 == 1
    for rows, schema in ((raw.where(~odd_hour), READING_SCHEMA), (raw.where(odd_hour), later)):
        messages = readings.keyed_messages(readings.with_reading_text(rows), fields=schema.fieldNames(), keep=["event_timestamp"])
        envelope_from_messages(messages, F.col("event_timestamp").cast("timestamp") + _seconds(1)).write.mode("append").parquet(log)
        reading = SchemaGenerations(spark, paths.base).at_start(schema)
        bronze = readings.parse_envelope(read_envelope_files(spark, log), _bronze_clock, schema=reading)
        layers.write_stream(bronze, paths.table("bronze"), paths.checkpoint("bronze"), partition_by=["grid_zone"]).awaitTermination()
    return _ntz(read_layer(spark, paths.table("bronze"), merge_schema=True).select(*BRONZE_COLUMNS, "firmware"))


def bronze_from_event_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the Event Hubs layout (body, enqueuedTime), parsed to bronze."""
    log = envelope_log(meter_readings(spark, sf_dir))
    records = log.select(F.col("value").alias("body"), F.col("timestamp").alias("enqueuedTime"), F.col("partition").cast("string").alias("partition"))
    return _ntz(readings.parse_envelope(from_event_hubs(records), _bronze_clock).select(*BRONZE_COLUMNS))


LOG_PARTITIONS = 3


def _log_with_offsets(spark: SparkSession, sf_dir: str) -> str:
    """The readings' log as envelope files, with offsets by log partition."""
    messages = readings.keyed_messages(meter_readings(spark, sf_dir, even=True), keep=["event_timestamp"])
    number = F.coalesce(F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("bigint") % LOG_PARTITIONS, F.lit(0))
    log = envelope_from_messages(messages, F.col("event_timestamp").cast("timestamp") + _seconds(1), partition=number)
    path = shared_dir(spark, "offset_log")
    assign_offsets(log, shared_dir(spark, "offset_scratch")).write.parquet(path)
    return path


def _texts(envelope: DataFrame) -> DataFrame:
    texts = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return _ntz(envelope.select(*texts, F.col("partition").cast("bigint").alias("partition"), "offset", "timestamp"))


def log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(read_envelope_files(spark, _once(spark, sf_dir, _log_with_offsets), stream=False))


def log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log replayed by a stream from an offset of its partition 0 and of
    partition 2, and all of partition 1."""
    log = from_offsets(read_envelope_files(spark, _once(spark, sf_dir, _log_with_offsets)), REPLAY_FROM)
    path = shared_dir(spark, "replayed")
    layers.write_stream(log, path, shared_dir(spark, "replay_checkpoint")).awaitTermination()
    return _texts(read_envelope_files(spark, path, stream=False))


REPLAY_FROM = {0: 25, 2: 100}

QUERIES.update(
    {
        f.__name__: f
        for f in (
            delivered_fact, delivered_dim_meters, delivered_dim_grid_zones, delivered_dim_dates, delivered_checks, publish_outcome,
            fact_upsert_manifest, gold_all_windows_stream, one_parse_gold, one_parse_all_windows, one_parse_late_rows, one_parse_silver,
            bronze_two_schemas_stream, bronze_from_event_hubs, log_offsets, log_replay,
        )
    }
)
