"""Watermark, append-mode and restart behaviour of the streaming layers.

One envelope file per micro-batch (``maxFilesPerTrigger=1``), files with
increasing modification times, 5-minute windows, 2-minute watermark.
"""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from meterlake.operators import readings, windows
from meterlake.schemas import ENVELOPE_SCHEMA
from meterlake.sources.log import read_envelope_files
from meterlake.streaming import layers


def _payload(time_text, kwh):
    return json.dumps(
        {
            "meter_id": "METER-0001",
            "timestamp": time_text,
            "kwh_reading": kwh,
            "voltage": 230.0,
            "frequency": 50.0,
            "grid_zone": "Bavaria",
            "meter_type": "residential",
            "is_anomaly": False,
        }
    )


def _write_batches(spark, folder, batches, start_index=0):
    os.makedirs(folder, exist_ok=True)
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    for i, batch in enumerate(batches, start=start_index):
        rows = []
        for hhmmss, kwh in batch:
            text = f"2026-05-20T{hhmmss}Z" if hhmmss else "garbage"
            rows.append((b"METER-0001", _payload(text, kwh).encode(), "t", 0, i, t0, 0))
        pdf_path = os.path.join(folder, f"batch-{i:03d}.parquet")
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).toPandas().to_parquet(pdf_path, coerce_timestamps="us")
        os.utime(pdf_path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


def _gold_stream(spark, log, out, ckpt):
    env = read_envelope_files(spark, log, max_files_per_trigger=1)
    gold = windows.gold(readings.silver(readings.parse_envelope(env)))
    q = layers.write_stream(gold, out, ckpt)
    q.awaitTermination()
    return q


def _sums(spark, out):
    rows = spark.read.parquet(out).select(F.date_format("window_start", "HH:mm").alias("w"), "total_kwh").collect()
    return {r.w: r.total_kwh for r in rows}


SEQ_A = [
    [("09:01:00", 1.0), ("09:04:59", 2.0)],
    [("09:06:59", 4.0)],
    [("09:02:00", 8.0)],
    [("09:07:00", 16.0)],
    [("09:03:00", 32.0)],
    [("09:30:00", 64.0), (None, 128.0)],
]

SEQ_B = [
    [("09:01:00", 1.0)],
    [("09:07:00", 2.0)],
    [("09:07:01", 4.0)],
    [("09:02:00", 8.0)],
    [("09:02:30", 16.0)],
]


def test_sequence_a_late_rows_counted_until_window_closes(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    _write_batches(spark, log, SEQ_A)
    _gold_stream(spark, log, f"{tmp_dir}/gold", f"{tmp_dir}/ckpt")
    # 09:00 = 1+2+8+32 (32 arrived in the batch that closed it), 09:05 = 4+16;
    # 09:30 is still open at the end; the NULL-time row is never counted.
    assert _sums(spark, f"{tmp_dir}/gold") == {"09:00": 43.0, "09:05": 20.0}


def test_sequence_b_rows_after_close_are_dropped(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    _write_batches(spark, log, SEQ_B)
    q = _gold_stream(spark, log, f"{tmp_dir}/gold", f"{tmp_dir}/ckpt")
    assert _sums(spark, f"{tmp_dir}/gold") == {"09:00": 1.0}
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0)
        for p in q.recentProgress
        for op in p.get("stateOperators", [])
    )
    assert dropped > 0


def test_restart_from_checkpoint_neither_loses_nor_repeats(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    out, ckpt = f"{tmp_dir}/gold", f"{tmp_dir}/ckpt"
    _write_batches(spark, log, SEQ_A[:3])
    _gold_stream(spark, log, out, ckpt)
    first = _sums(spark, out)
    _write_batches(spark, log, SEQ_A[3:], start_index=3)
    _gold_stream(spark, log, out, ckpt)
    assert first == {}
    assert _sums(spark, out) == {"09:00": 43.0, "09:05": 20.0}


def test_chained_and_fanout_layouts_agree(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    _write_batches(spark, log, [sum(SEQ_A, [])])  # one batch: nothing is late
    results = {}
    for mode in ("chained", "fanout"):
        paths = layers.LayerPaths(f"{tmp_dir}/{mode}")
        layers.start_medallion(spark, read_envelope_files(spark, log), paths, mode=mode)
        results[mode] = (
            spark.read.parquet(paths.table("bronze")).count(),
            spark.read.parquet(paths.table("silver")).count(),
            _sums(spark, paths.table("gold")),
        )
    assert results["chained"] == results["fanout"]
    bronze, silver, gold = results["chained"]
    assert bronze == 8 and silver == 8
    # watermark = 09:30 - 2 min: 09:00 and 09:05 closed, 09:30 open
    assert gold == {"09:00": 43.0, "09:05": 20.0}


def test_bronze_partitions_null_zone_under_default_partition(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    os.makedirs(log)
    rows = [(None, b"not json", "t", 0, 0, dt.datetime(2026, 5, 20, 9), 0),
            (None, _payload("2026-05-20T09:00:00Z", 1.0).encode(), "t", 0, 1, dt.datetime(2026, 5, 20, 9), 0)]
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).write.parquet(log, mode="append")
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    bronze = readings.parse_envelope(read_envelope_files(spark, log))
    layers.write_stream(bronze, paths.table("bronze"), paths.checkpoint("bronze"), partition_by=["grid_zone"]).awaitTermination()
    assert any("__HIVE_DEFAULT_PARTITION__" in d for d in os.listdir(paths.table("bronze")))
    back = spark.read.parquet(paths.table("bronze"))
    assert back.count() == 2 and back.where("grid_zone is null").count() == 1


def test_schema_evolution_merge_on_read(spark, tmp_dir):
    from meterlake.sources.tables import read_layer

    path = f"{tmp_dir}/bronze"
    spark.createDataFrame([("M1", 1.0)], "meter_id string, kwh_reading double").write.parquet(f"{path}/part=1")
    spark.createDataFrame([("M2", 2.0, "fw2")], "meter_id string, kwh_reading double, firmware string").write.parquet(
        f"{path}/part=2"
    )
    df = read_layer(spark, path, merge_schema=True)
    assert "firmware" in df.columns and df.count() == 2


def test_live_layers_run_concurrently_then_stop(spark, tmp_dir):
    """Processing-time triggers: all three layers run at once (F7); a
    bounded wait then stops every active query (F8)."""
    log = f"{tmp_dir}/log"
    _write_batches(spark, log, [sum(SEQ_A, [])])
    for mode in ("fanout", "chained"):
        paths = layers.LayerPaths(f"{tmp_dir}/{mode}")
        started = layers.start_medallion(
            spark, read_envelope_files(spark, log), paths, mode=mode, trigger="1 second"
        )
        assert all(q.isActive for q in started.values())
        for name in ("bronze", "silver", "gold"):
            started[name].processAllAvailable()
        other = spark.readStream.format("rate").load().writeStream.format("noop").start()
        layers.run_bounded(started, 0.5)
        assert not any(q.isActive for q in started.values())
        assert other.isActive  # a query of someone else in the session goes on
        other.stop()
        assert spark.read.parquet(paths.table("silver")).count() == 8


def test_load_rerun_appends_again(spark, tmp_dir):
    from meterlake.sinks import warehouse

    silver_path = f"{tmp_dir}/silver"
    env = spark.createDataFrame(
        [(None, _payload("2026-05-20T09:00:00Z", 1.0).encode(), "t", 0, 0, dt.datetime(2026, 5, 20, 9), 0)],
        ENVELOPE_SCHEMA,
    )
    readings.silver(readings.parse_envelope(env)).write.partitionBy("grid_zone").parquet(silver_path)
    table = "load_rerun_" + os.path.basename(tmp_dir).replace("-", "_")
    first = warehouse.load_silver(spark, silver_path, table, f"{tmp_dir}/wh")
    second = warehouse.load_silver(spark, silver_path, table, f"{tmp_dir}/wh")
    assert first.rows_loaded == 1 and second.rows_loaded == 1
    t = spark.table(table)
    assert t.count() == 2 and "METER_ID" in t.columns and len(t.columns) == 13
    assert dict(t.dtypes)["EVENT_TIMESTAMP"] == "timestamp_ntz"


def test_future_clock_closes_windows_for_all_meters(spark, tmp_dir):
    """One global watermark: a reading from the future (no upper bound in
    silver) closes every open window, so later on-time rows are dropped."""
    log = f"{tmp_dir}/log"
    batches = [[("09:01:00", 1.0)], [("23:59:00", 2.0)], [("09:02:00", 4.0)], [("09:03:00", 8.0)]]
    _write_batches(spark, log, batches)
    _gold_stream(spark, log, f"{tmp_dir}/gold", f"{tmp_dir}/ckpt")
    # 09:02 arrives in the batch that closes 09:00 and is still counted (late
    # rows are tested against the previous batch's watermark); 09:03, one
    # batch later, is dropped. The 23:55 window stays open.
    assert _sums(spark, f"{tmp_dir}/gold") == {"09:00": 5.0}


def test_date_partitioned_layers_prune_by_date(spark, tmp_dir, capsys):
    log = f"{tmp_dir}/log"
    _write_batches(spark, log, [sum(SEQ_A, [])])
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    layers.start_medallion(spark, read_envelope_files(spark, log), paths, date_partitions=True)
    silver = spark.read.parquet(paths.table("silver"))
    assert "event_date=2026-05-20" in os.listdir(paths.table("silver"))
    day = silver.where(F.col("event_date") == F.lit("2026-05-20").cast("date"))
    day.explain()
    assert "PartitionFilters: [isnotnull(event_date" in capsys.readouterr().out
    assert day.count() == 7  # the NULL-time row sits in the default partition
    assert _sums(spark, paths.table("gold")) == {"09:00": 43.0, "09:05": 20.0}


def test_rocksdb_state_store_gives_the_same_gold(spark, tmp_dir):
    log = f"{tmp_dir}/log"
    _write_batches(spark, log, [sum(SEQ_A, [])])
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    layers.start_medallion(
        spark, read_envelope_files(spark, log), paths, state_store="rocksdb", gold_state_partitions=2
    )
    assert _sums(spark, paths.table("gold")) == {"09:00": 43.0, "09:05": 20.0}
    assert spark.conf.get(layers._PROVIDER, None) != layers._ROCKSDB


def test_layer_reads_go_through_the_sink_commit_log(spark, tmp_dir):
    """A file in a layer folder that no committed batch wrote (a failed or
    foreign write) is not read: batch reads use the sink's commit log."""
    from meterlake.sources.tables import read_layer

    log = f"{tmp_dir}/log"
    _write_batches(spark, log, [sum(SEQ_A, [])])
    paths = layers.LayerPaths(f"{tmp_dir}/m")
    layers.start_medallion(spark, read_envelope_files(spark, log), paths)
    gold_dir = paths.table("gold")
    before = read_layer(spark, gold_dir).count()
    stray = spark.read.parquet(gold_dir)
    stray.write.parquet(f"{tmp_dir}/stray")
    part = [f for f in os.listdir(f"{tmp_dir}/stray") if f.endswith(".parquet")][0]
    os.link(f"{tmp_dir}/stray/{part}", f"{gold_dir}/uncommitted-{part}")
    assert read_layer(spark, gold_dir).count() == before == 2
