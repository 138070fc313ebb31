"""Incremental fact: first run, later runs, empty target, NULL hours."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterlake.operators import marts
from meterlake.plans import materialize

SCHEMA = (
    "meter_id string, event_timestamp timestamp_ntz, kwh_reading double, voltage double, frequency double,"
    " grid_zone string, meter_type string, is_anomaly boolean, ingest_timestamp timestamp_ntz,"
    " processed_timestamp timestamp_ntz"
)


def _rows(spark, items):
    rows = [("M1", t, kwh, 230.0, 50.0, "Bavaria", "residential", False, t, t) for t, kwh in items]
    return spark.createDataFrame(rows, SCHEMA)


def T(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def test_first_run_builds_then_only_later_hours_append(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    r1 = materialize.incremental_fact(spark, _rows(spark, [(T(1), 1.0), (T(2, 10), 2.0)]), target)
    assert r1.mode == "full"
    # a late reading for 02:00 (the newest hour) and one for 03:00
    more = _rows(spark, [(T(1), 1.0), (T(2, 10), 2.0), (T(2, 40), 5.0), (T(3, 5), 7.0)])
    r2 = materialize.incremental_fact(spark, more, target)
    assert r2.mode == "incremental" and r2.high_water_mark.startswith("2024-01-01 02:00:00")
    got = {r.consumption_hour.hour: r.total_kwh for r in materialize.read_fact(spark, target).collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 7.0}  # 02:00 stays half full for ever


def test_empty_existing_target_receives_nothing(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    empty = marts.fact_consumption(marts.hourly_consumption(_rows(spark, [(T(1), 1.0)]))).limit(0)
    materialize.with_partition(empty).write.partitionBy(materialize.FACT_PARTITION).parquet(target)
    r = materialize.incremental_fact(spark, _rows(spark, [(T(5), 1.0)]), target)
    assert r.mode == "skipped"
    schema = materialize.with_partition(empty).schema
    assert materialize.read_fact(spark, target, schema).count() == 0


def test_null_hour_enters_on_first_run_only(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    materialize.incremental_fact(spark, _rows(spark, [(None, 1.0), (T(1), 2.0)]), target)
    fact = materialize.read_fact(spark, target)
    assert fact.where("consumption_hour is null").count() == 1
    materialize.incremental_fact(spark, _rows(spark, [(None, 9.0), (T(1), 2.0), (T(4), 3.0)]), target)
    fact = materialize.read_fact(spark, target)
    assert fact.where("consumption_hour is null").agg(F.sum("total_kwh")).first()[0] == 1.0
    assert fact.count() == 3


def test_full_refresh_rebuilds(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    materialize.incremental_fact(spark, _rows(spark, [(T(1), 1.0)]), target)
    materialize.incremental_fact(spark, _rows(spark, [(T(1), 1.0), (T(1, 30), 4.0)]), target, full_refresh=True)
    assert materialize.read_fact(spark, target).first().total_kwh == 5.0


def test_incremental_scan_pushes_the_cut(spark, tmp_dir, capsys):
    """The high-water mark reaches the parquet scan as a pushed filter."""
    src = f"{tmp_dir}/src"
    _rows(spark, [(T(1), 1.0), (T(3), 2.0)]).write.parquet(src)
    staged = spark.read.parquet(src)
    cut = F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")
    staged.where(F.col("event_timestamp") >= F.date_trunc("hour", cut).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")).explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(event_timestamp), GreaterThanOrEqual(event_timestamp" in plan


def test_upsert_replaces_keys_in_touched_partitions_only(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    base = _rows(spark, [(T(1), 1.0), (T(2), 2.0)]).union(
        _rows(spark, [(dt.datetime(2024, 1, 2, 1), 9.0)])
    )
    materialize.incremental_fact(spark, base, target)
    updates = marts.fact_consumption(marts.hourly_consumption(_rows(spark, [(T(2), 20.0), (T(5), 5.0)])))
    materialize.upsert_fact(spark, target, updates)
    got = {
        (r.consumption_hour.day, r.consumption_hour.hour): r.total_kwh
        for r in materialize.read_fact(spark, target).collect()
    }
    assert got == {(1, 1): 1.0, (1, 2): 20.0, (1, 5): 5.0, (2, 1): 9.0}


def test_full_refresh_drops_dates_absent_from_the_new_data(spark, tmp_dir):
    target = f"{tmp_dir}/fact"
    materialize.incremental_fact(spark, _rows(spark, [(T(1), 1.0), (dt.datetime(2024, 1, 5, 1), 2.0)]), target)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        materialize.incremental_fact(spark, _rows(spark, [(T(1), 3.0)]), target, full_refresh=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    rows = materialize.read_fact(spark, target).collect()
    assert [(r.consumption_hour, r.total_kwh) for r in rows] == [(T(1), 3.0)]
