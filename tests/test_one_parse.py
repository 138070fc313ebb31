"""The layers from one query: equal layers, one parse, late rows, open windows, batches run again; schema generations; offsets."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import __main__ as cli
from meterlake.operators import readings, windows
from meterlake.plans import registry
from meterlake.schemas import ENVELOPE_SCHEMA, GOLD_COLUMNS, READING_SCHEMA
from meterlake.sources.fixtures import meter_readings
from meterlake.sources.log import assign_offsets, from_offsets, read_envelope_files, read_log
from meterlake.streaming import layers
from meterlake.streaming.generations import SchemaChange, SchemaGenerations, evolved
from meterlake.streaming.one_parse import OneParse


def at(minute, second=0):
    return dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=minute, seconds=second)


def write(spark, path, times, **more):
    """One file of readings on the log."""
    rows = []
    for t in times:
        body = {"meter_id": "M1", "timestamp": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "kwh_reading": 1.0, "voltage": 230.0, "frequency": 50.0,
                "grid_zone": "Bavaria", "meter_type": "residential", "is_anomaly": False, **more}
        rows.append((None, json.dumps(body).encode(), "t", 0, None, t, 0))
    spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, out, log, **how):
    out.start(read_envelope_files(spark, log), **how).awaitTermination()


def _windows(df):
    return sorted((r.window_start.strftime("%H:%M"), r.meter_count) for r in df.collect())


def test_late_rows_are_set_aside_and_open_windows_are_kept(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", OneParse(spark, f"{tmp_dir}/out")
    write(spark, log, [at(1), at(4), at(6)])
    run(spark, out, log)  # watermark 10:04
    assert _windows(out.read("gold")) == [] and _windows(out.open_windows()) == [("10:00", 2), ("10:05", 1)]
    write(spark, log, [at(2), at(7)])  # watermark 10:05: the first window closes, with the late row
    run(spark, out, log)
    assert _windows(out.read("gold")) == [("10:00", 3)] and _windows(out.open_windows()) == [("10:05", 2)]
    write(spark, log, [at(3), at(8)])  # 10:03 is late now
    run(spark, out, log)
    assert [r.event_timestamp for r in out.read("late").collect()] == [at(3)]
    assert _windows(out.read("gold").unionByName(out.open_windows())) == [("10:00", 3), ("10:05", 3)]
    timed = out.read("silver").count()
    assert timed == 7 == 6 + out.read("late").count()
    assert out.read("gold").columns == GOLD_COLUMNS


def test_open_windows_of_the_chained_layers_come_from_the_state(spark, tmp_dir):
    paths = layers.LayerPaths(f"{tmp_dir}/chained")
    write(spark, f"{tmp_dir}/log", [at(1), at(4), at(8), at(9)], is_anomaly=True)
    layers.start_medallion(spark, read_envelope_files(spark, f"{tmp_dir}/log"), paths, gold_state_partitions=2)
    assert _windows(spark.read.parquet(paths.table("gold"))) == [("10:00", 2)]
    row = layers.open_windows(spark, paths).first()
    assert (row.window_start, row.meter_count, row.anomaly_count, row.total_kwh, row.avg_voltage, row.avg_frequency) == (at(5), 2, 2, 2.0, 230.0, 50.0)


def test_a_batch_that_is_run_again_counts_once(spark, tmp_dir, monkeypatch):
    log, out = f"{tmp_dir}/log", OneParse(spark, f"{tmp_dir}/out")
    write(spark, log, [at(1), at(20)])
    commit, writes = out.manifest.update, []

    def dies(change):
        writes.append(1)
        if len(writes) == 1:
            raise RuntimeError("killed before the commit")
        commit(change)
        raise RuntimeError("killed after the commit")

    monkeypatch.setattr(out.manifest, "update", dies)
    for k in range(2):
        with pytest.raises(Exception, match="killed"):
            run(spark, out, log)
        assert out.read("bronze").count() == 2 * k
    monkeypatch.setattr(out.manifest, "update", commit)
    run(spark, out, log)
    counts = {layer: out.read(layer).count() for layer in ("bronze", "silver", "gold", "late")}
    assert counts == {"bronze": 2, "silver": 2, "gold": 1, "late": 0}


def test_one_parse_equals_the_chained_layers_and_compacts(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", OneParse(spark, f"{tmp_dir}/one", registry._bronze_clock, registry._silver_clock, fan_in=2)
    paths = layers.LayerPaths(f"{tmp_dir}/chained")
    for k in range(2):
        write(spark, log, [at(30 * k + m, k) for m in range(12)] + [at(30 * k)])
        run(spark, out, log)
        layers.start_medallion(spark, read_envelope_files(spark, log), paths, bronze_clock=registry._bronze_clock,
                               silver_clock=registry._silver_clock, gold_state_partitions=1)
    write(spark, log, [], voltage=None)
    before = {layer: sorted(map(str, out.read(layer).collect())) for layer in ("bronze", "silver", "gold")}
    parts = len(out.manifest.current()[1]["bronze"])
    out.compact()
    assert len(out.manifest.current()[1]["bronze"]) == 1 < parts
    for layer, rows in before.items():
        columns = out.read(layer).columns
        assert sorted(map(str, out.read(layer).collect())) == rows
        assert sorted(map(str, spark.read.parquet(paths.table(layer)).select(*columns).collect())) == rows
    write(spark, log, [at(90)])
    run(spark, out, log)  # the next run is not harmed
    assert out.read("bronze").count() == len(before["bronze"]) + 1
    assert out.vacuum(keep=1) and out.read("gold").count() > 2


def test_the_batch_is_parsed_once(spark, tmp_dir):
    """Silver and the window totals come from the held batch: their plans scan memory and parse nothing."""
    write(spark, f"{tmp_dir}/log", [at(1)])
    bronze = readings.parse_envelope(read_envelope_files(spark, f"{tmp_dir}/log", stream=False)).persist()
    for df in (readings.silver(bronze), windows.window_totals(readings.silver(bronze))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan and plan.split("InMemoryRelation")[0].count("from_json") == 0
    bronze.unpersist()


def test_the_log_is_written_by_all_cores_from_one_row_group(spark, tmp_dir, monkeypatch):
    """A scan gives a row group to one task; the readings' JSON is made, and the log parsed, in many."""
    hour = "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 48 as int))"
    events = spark.range(2000).selectExpr("id as event_id", f"if(id % 61 = 0, null, {hour}) as ts", "if(id % 67 = 0, null, id % 40) as user_id",
                                          "'view' as event_type", "id / 4e0 as value", "'{}' as props")
    events.unionAll(events.where("event_id < 5")).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    plain, even = (meter_readings(spark, tmp_dir, "dense", even=e) for e in (False, True))
    assert even.schema == plain.schema and sorted(map(str, even.collect())) == sorted(map(str, plain.collect()))
    monkeypatch.setattr(registry, "shared_dir", lambda spark, *parts: f"{tmp_dir}/{'_'.join(parts)}")
    out = registry._one_parse(spark, tmp_dir)
    log = read_envelope_files(spark, f"{tmp_dir}/one_parse_log", stream=False)
    rows = [r["count"] for r in log.groupBy(F.input_file_name()).count().collect()]
    assert sum(rows) == plain.where("event_timestamp is not null").count() == out.read("bronze").count()
    assert max(rows) < sum(rows) / max(2, spark.sparkContext.defaultParallelism / 2)


LATER = T.StructType([*READING_SCHEMA.fields, T.StructField("firmware", T.StringType())])


@pytest.mark.parametrize("layout", ["chained", "one_parse"])
def test_a_later_schema_on_the_same_checkpoints(spark, tmp_dir, layout):
    log = f"{tmp_dir}/log"
    paths, out = layers.LayerPaths(f"{tmp_dir}/out"), OneParse(spark, f"{tmp_dir}/out")

    def go(schema=None):
        if layout == "one_parse":
            run(spark, out, log, schema=schema)
        else:
            layers.start_medallion(spark, read_envelope_files(spark, log), paths, schema=schema, gold_state_partitions=1)

    write(spark, log, [at(1)], firmware="ignored yet")
    go()
    write(spark, log, [at(2)], firmware="fw-2")
    go(LATER)
    write(spark, log, [at(3)], firmware="fw-3")
    go()  # the newest generation is picked
    for layer in ("bronze", "silver"):
        df = out.read(layer) if layout == "one_parse" else spark.read.option("mergeSchema", True).parquet(paths.table(layer))
        assert [r.firmware for r in df.orderBy("event_timestamp").collect()] == [None, "fw-2", "fw-3"]
    assert SchemaGenerations(spark, f"{tmp_dir}/out").current() == LATER


def test_generations_only_add_fields():
    assert evolved(LATER, READING_SCHEMA) == LATER
    with pytest.raises(SchemaChange, match="voltage is double"):
        evolved(READING_SCHEMA, T.StructType([f if f.name != "voltage" else T.StructField("voltage", T.StringType()) for f in READING_SCHEMA.fields]))
    with pytest.raises(SchemaChange, match="frequency"):
        evolved(READING_SCHEMA, T.StructType([f for f in READING_SCHEMA.fields if f.name != "frequency"]))


def test_offsets_are_gapless_and_replay_starts_at_them(spark, tmp_dir, capsys):
    rows = [(None, str(k % 5).encode(), "t", k % 3 if k % 10 else 7, None, at(0, (k * 37) % 50), 0) for k in range(300)]
    log = assign_offsets(spark.createDataFrame(rows, ENVELOPE_SCHEMA).repartition(6), f"{tmp_dir}/scratch", start=100)
    log.write.parquet(f"{tmp_dir}/log")
    files = read_envelope_files(spark, f"{tmp_dir}/log", stream=False)
    seen: dict = {}
    for r in files.orderBy("partition", "offset").collect():
        seen.setdefault(r.partition, []).append((r.offset, r.timestamp))
    assert set(seen) == {0, 1, 2, 7}
    for places in seen.values():
        assert [o for o, _ in places] == list(range(100, 100 + len(places)))
        assert [t for _, t in places] == sorted(t for _, t in places)
    replay = from_offsets(files, {0: 150, 7: 110}, others="latest")
    assert replay.count() == len(seen[0]) - 50 + len(seen[7]) - 10
    assert from_offsets(files, {0: 150}).count() == 300 - 50 == from_offsets(files, {}).count() - 50
    replay.explain()
    assert "PushedFilters: [Or(And(EqualTo(partition,0),GreaterThanOrEqual(offset,150" in capsys.readouterr().out
    with pytest.raises(ValueError):
        from_offsets(files, {}, others="middle")


def test_the_log_source_passes_its_options():
    class Reader:
        def __init__(self):
            self.given = {}

        def format(self, name):
            self.given["format"] = name
            return self

        def option(self, key, value):
            self.given[key] = value
            return self

        def load(self):
            return self.given

    class Session:
        readStream = Reader()

    given = read_log(Session(), "b:1", "topic", '{"topic":{"0":23}}', max_offsets_per_trigger=5, options={"kafka.security.protocol": "SASL_SSL"})
    assert given == {"format": "kafka", "kafka.bootstrap.servers": "b:1", "subscribe": "topic", "startingOffsets": '{"topic":{"0":23}}',
                     "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5", "kafka.security.protocol": "SASL_SSL"}
    Session.readStream = Reader()
    assert read_log(Session(), "b:1")["startingOffsets"] == "latest"


def _failing_gold(spark, tmp_dir):
    log, paths = f"{tmp_dir}/log", layers.LayerPaths(f"{tmp_dir}/out")
    write(spark, log, [at(1)])
    bronze = readings.parse_envelope(read_envelope_files(spark, log))
    good = layers.write_stream(bronze, paths.table("bronze"), paths.checkpoint("bronze"), trigger="1 second")
    bad = bronze.select(F.raise_error(F.lit("gold is broken")).alias("x"))
    return {"bronze": good, "gold": layers.write_stream(bad, paths.table("gold"), paths.checkpoint("gold"), trigger="1 second")}


def test_a_failure_of_any_layer_ends_the_bounded_run(spark, tmp_dir):
    started = _failing_gold(spark, tmp_dir)
    with pytest.raises(Exception, match="gold is broken"):
        layers.run_bounded(started, 60)
    assert not any(q.isActive for q in started.values())


def test_a_deadline_in_the_past_stops_at_once(spark, tmp_dir):
    write(spark, f"{tmp_dir}/log", [at(1)])
    bronze = readings.parse_envelope(read_envelope_files(spark, f"{tmp_dir}/log"))
    for k, timeout in enumerate((0, -5)):
        q = layers.write_stream(bronze, f"{tmp_dir}/b{k}", f"{tmp_dir}/c{k}", trigger="1 second")
        layers.run_bounded({"bronze": q}, timeout)
        assert not q.isActive


def test_the_command_fails_with_its_stream(spark, tmp_dir, monkeypatch):
    write(spark, f"{tmp_dir}/log", [at(1)])
    monkeypatch.setattr(cli, "build_session", lambda master: spark)
    monkeypatch.setattr(layers, "start_medallion", lambda *a, **k: _failing_gold(spark, f"{tmp_dir}/x"))
    with pytest.raises(Exception, match="gold is broken"):
        cli.main(["stream", "--log-dir", f"{tmp_dir}/log", "--out", f"{tmp_dir}/out", "--trigger", "1 second", "--timeout", "30"])
