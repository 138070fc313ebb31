"""Sources and sinks: directory reads, declared tables, publish / replay."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterlake.operators import readings, windows
from meterlake.plans import registry
from meterlake.sinks.publish import publish_messages, write_envelope_files
from meterlake.sources.fixtures import meter_readings
from meterlake.sources.log import read_envelope_files
from meterlake.sources.tables import read_parquet_dir, source_table
from meterlake.streaming import layers
from tests.conftest import SF_SMALL


def test_directory_read_fails_when_missing_or_empty(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        read_parquet_dir(spark, f"{tmp_dir}/absent")
    os.makedirs(f"{tmp_dir}/empty")
    with pytest.raises(AnalysisException):
        read_parquet_dir(spark, f"{tmp_dir}/empty")


def test_directory_read_discovers_zone_partitions(spark, tmp_dir):
    silver = readings.silver(registry._bronze(spark, SF_SMALL), registry._silver_clock)
    silver.write.partitionBy("grid_zone").parquet(f"{tmp_dir}/silver")
    back = read_parquet_dir(spark, f"{tmp_dir}/silver")
    assert back.select("grid_zone").distinct().count() == 5
    assert back.count() == 936


def test_declared_source_table(spark):
    meter_readings(spark, SF_SMALL).createOrReplaceTempView("meter_readings_src")
    assert readings.staging(source_table(spark, "meter_readings_src")).count() == 936


def test_publish_then_replay_round_trips(spark, tmp_dir):
    raw = meter_readings(spark, SF_SMALL)
    msgs = readings.keyed_messages(raw, keep=["event_timestamp"])
    publish_messages(msgs, f"{tmp_dir}/log", log_time=F.col("event_timestamp").cast("timestamp"))
    bronze = readings.parse_envelope(read_envelope_files(spark, f"{tmp_dir}/log", stream=False))
    assert bronze.count() == 1000
    assert readings.staging(readings.silver(bronze)).count() == 936


def test_stream_output_equals_batch_closed_form(spark, tmp_dir):
    log = write_envelope_files(registry.envelope_log(meter_readings(spark, SF_SMALL, "dense")), f"{tmp_dir}/log")
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    layers.start_medallion(spark, read_envelope_files(spark, log), paths)
    streamed = spark.read.parquet(paths.table("gold"))
    staged = readings.staging(meter_readings(spark, SF_SMALL, "dense"))
    closed = windows.closed_windows(windows.gold(staged, watermark=None), staged)
    keys = ["window_start", "grid_zone", "meter_type", "meter_count", "anomaly_count"]
    s = streamed.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), *keys[1:])
    c = closed.select(*keys)
    assert s.count() == c.count() == 753
    assert s.exceptAll(c).count() == 0


def test_periodic_runs_over_a_filling_log_equal_the_closed_form(spark, tmp_dir):
    """The log receives three time slices; after each, one bounded run of
    the chained layers resumes from the same checkpoints. Windows spanning a
    slice boundary stay in gold's state between runs."""
    raw = meter_readings(spark, SF_SMALL, "dense")
    log = f"{tmp_dir}/log"
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    cuts = ["2024-01-01 00:00:00", "2024-01-01 04:02:30", "2024-01-01 08:01:10", "2024-01-02 00:00:00"]
    for lo, hi in zip(cuts, cuts[1:]):
        ts = F.col("event_timestamp")
        part = raw.where((ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz")))
        registry.envelope_log(part).write.mode("append").parquet(log)
        layers.start_medallion(spark, read_envelope_files(spark, log), paths)
    streamed = spark.read.parquet(paths.table("gold"))
    staged = readings.staging(raw)
    closed = windows.closed_windows(windows.gold(staged, watermark=None), staged)
    keys = ["window_start", "grid_zone", "meter_type", "meter_count", "anomaly_count"]
    s = streamed.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), *keys[1:])
    assert s.count() == 753
    assert s.exceptAll(closed.select(*keys)).count() == 0
    assert spark.read.parquet(paths.table("bronze")).count() == 1000


def test_out_of_order_runs_follow_the_late_row_rule(spark, tmp_dir):
    """Even hours arrive first, odd hours in a later run. A row of the later
    run is dropped iff its window ended at or before the watermark left by
    the earlier run (max event time so far minus 2 minutes); the output
    holds the windows the final watermark has passed. Checked against a
    brute-force batch computation of that rule at table scale."""
    raw = meter_readings(spark, SF_SMALL, "dense")
    log = f"{tmp_dir}/log"
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    odd = F.hour("event_timestamp") % 2 == 1
    for part in (raw.where(~odd), raw.where(odd)):
        registry.envelope_log(part).write.mode("append").parquet(log)
        layers.start_medallion(spark, read_envelope_files(spark, log), paths)
    streamed = spark.read.parquet(paths.table("gold"))

    staged = readings.staging(raw).where(F.col("event_timestamp").isNotNull())
    delay = F.expr("INTERVAL 2 MINUTES")
    w1 = staged.where(~odd).select(F.max("event_timestamp") - delay).scalar()
    w2 = staged.select(F.max("event_timestamp") - delay).scalar()
    window_end = F.window("event_timestamp", "5 minutes").end
    kept = staged.where(~odd | (window_end > w1))
    expected = windows.gold(kept, watermark=None).where(F.col("window_end") <= w2)

    keys = ["window_start", "grid_zone", "meter_type", "meter_count", "anomaly_count"]
    s = streamed.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), *keys[1:])
    e = expected.select(*keys)
    assert s.count() == e.count() > 0
    assert s.exceptAll(e).count() == 0 and e.exceptAll(s).count() == 0
    # the late run really lost rows: fewer than all validated readings count
    assert streamed.agg(F.sum("meter_count")).first()[0] < staged.count()
