"""Missing hours on upsert, empty layers, deliveries, schema generations, scratch rules."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterlake import config
from meterlake.__main__ import main
from meterlake.operators import marts, quality, readings, reports
from meterlake.plans import materialize, registry
from meterlake.sinks import warehouse
from meterlake.sinks.publish import write_envelope_files
from meterlake.sources.fixtures import meter_readings
from meterlake.sources.log import read_envelope_files
from meterlake.streaming import layers
from tests.conftest import SF_SMALL


def test_upsert_of_one_null_hour_key_keeps_the_others(spark, tmp_dir):
    staged = registry.models(spark, SF_SMALL, "edge").staging
    fact = marts.fact_consumption(marts.hourly_consumption(staged))
    target = f"{tmp_dir}/fact"
    materialize.incremental_fact(spark, staged, target)
    null_hours = fact.where("consumption_hour is null")
    one = null_hours.orderBy("consumption_id").limit(1)
    assert null_hours.count() > 1
    materialize.upsert_fact(spark, target, one.withColumn("reading_count", F.lit(77).cast("bigint")))
    after = materialize.read_fact(spark, target)
    assert after.count() == fact.count()
    assert after.where("reading_count = 77").count() == 1


def test_an_unreadable_target_is_not_taken_for_a_missing_one(spark, tmp_dir, monkeypatch):
    target = f"{tmp_dir}/fact"
    staged = registry.models(spark, SF_SMALL).staging
    materialize.incremental_fact(spark, staged, target)
    before = materialize.read_fact(spark, target).count()

    class Denied(AnalysisException):
        def __init__(self):
            super().__init__("denied")

        def getCondition(self):
            return "ACCESS_DENIED"

    class Reader:
        def schema(self, _):
            return self

        def parquet(self, _):
            raise Denied

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    with pytest.raises(AnalysisException):
        materialize.incremental_fact(spark, staged, target)
    monkeypatch.undo()
    assert materialize.read_fact(spark, target).count() == before


def test_ranking_of_an_unknown_state_is_empty(spark):
    m = registry.models(spark, SF_SMALL)
    assert reports.zone_hour_rank(m.fact, m.dim_grid_zones, "Atlantis").collect() == []


def test_ranking_rounds_large_totals_relatively(spark):
    df = spark.createDataFrame([(12345678901.0000019,), (12345678901.0000038,), (0.1 + 0.2,), (0.3,), (0.0,), (-5e9,)], "x double")
    got = [r[0] for r in df.select(reports.stable("x")).collect()]
    assert got[0] == got[1] and got[2] == got[3] and got[4] == 0.0 and got[5] == -5e9


def test_a_run_over_malformed_payloads_counts_empty_layers(spark, tmp_dir, capsys):
    bad = registry.envelope_log(meter_readings(spark, SF_SMALL)).withColumn("value", F.lit("{").cast("binary")).limit(20)
    log = write_envelope_files(bad, f"{tmp_dir}/log")
    assert main(["stream", "--log-dir", log, "--out", f"{tmp_dir}/layers", "--min-batches-to-retain", "5"]) == 0
    out = capsys.readouterr().out
    assert [line.split("|")[1:3] for line in out.splitlines() if line.startswith("|bronze") or line.startswith("|silver") or line.startswith("|gold")] == [
        ["bronze", "20       "], ["silver", "0        "], ["gold  ", "0        "]]
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "100"  # put back


def test_load_then_models_by_the_command(spark, tmp_dir, capsys):
    silver = readings.silver(registry._bronze(spark, SF_SMALL), registry._silver_clock)
    silver.write.partitionBy("grid_zone").parquet(f"{tmp_dir}/silver")
    warehouse.load_silver(spark, f"{tmp_dir}/silver", "round_two_load", f"{tmp_dir}/wh")
    assert main(["models", "--source-table", "round_two_load", "--out", f"{tmp_dir}/marts"]) == 0
    assert "fact run: full" in capsys.readouterr().out


def test_checks_run_once(spark, tmp_dir):
    results = quality.evaluate({"meter_readings": meter_readings(spark, SF_SMALL)}, quality.SOURCE_SUITE)
    assert "FileScan" not in quality.evaluated(results)._jdf.queryExecution().executedPlan().toString()
    assert quality.outcome(results).collect()[0].asDict() == {"checks": 6, "failed": 2, "passed": False}


def test_a_delivery_run_again_counts_once(spark, tmp_dir):
    staged = registry.models(spark, SF_SMALL).staging
    feed, path, checkpoint = f"{tmp_dir}/feed", f"{tmp_dir}/mh", f"{tmp_dir}/checkpoint"
    odd = F.hour("event_timestamp") % 2 == 1
    read = []
    for part in (staged.where(~odd), staged.where(odd)):
        part.coalesce(1).write.mode("append").parquet(feed)
        query = layers.update_meter_hours(layers.read_layer_stream(spark, feed, staged.schema), path, checkpoint)
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    assert read == [staged.where(~odd).count(), staged.where(odd).count()]  # the second run reads the new files only
    parts = marts.meter_hour_parts(staged.where(odd))
    parts.write.mode("overwrite").parquet(f"{path}/delivery=1")  # the same delivery once more
    merged, direct = layers.read_meter_hours(spark, path), marts.meter_hours(staged)
    assert merged.columns == direct.columns
    rounded = lambda df: sorted(str(r) for r in df.withColumns({c: F.round(c, 6) for c in ("total_kwh", "avg_kwh", "max_kwh")}).collect())
    assert rounded(merged) == rounded(direct)


def test_the_session_default_checkpoint_location(spark, tmp_dir):
    spark.conf.set("spark.sql.streaming.checkpointLocation", f"{tmp_dir}/default")
    try:
        stream = read_envelope_files(spark, write_envelope_files(registry.envelope_log(meter_readings(spark, SF_SMALL)), f"{tmp_dir}/log"))
        layers.write_stream(readings.parse_envelope(stream), f"{tmp_dir}/bronze", query_name="round_two").awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.checkpointLocation")
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 1000
    import os

    assert os.listdir(f"{tmp_dir}/default") == ["round_two"]


def test_a_cluster_takes_no_file_folder_for_scratch(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, *a: "file:///tmp/x")
    with pytest.raises(RuntimeError, match="do not share"):
        config.shared_dir(spark, "x")


def test_scratch_goes_when_the_session_ends(spark):
    path = config.shared_dir(spark, "short_lived")
    spark.range(3).write.parquet(path)
    config._delete(spark, path)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    done = []
    config.at_session_end(spark, lambda: done.append(1))
    kept = config._ENDINGS[id(spark.sparkContext)][:-1]
    config._ENDINGS[id(spark.sparkContext)] = config._ENDINGS[id(spark.sparkContext)][-1:]
    config._end(spark, id(spark.sparkContext))
    assert done == [1]
    config._ENDINGS[id(spark.sparkContext)] = kept
