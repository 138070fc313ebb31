"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pyspark.sql.functions as F

from meterlake.operators import readings, reports, windows
from meterlake.plans import registry
from tests.conftest import SF_SMALL


def _explain(df, capsys) -> str:
    capsys.readouterr()
    df.explain(extended=True)
    return capsys.readouterr().out


def _plan(df, capsys) -> str:
    return _explain(df, capsys).split("== Physical Plan ==", 1)[1]


def _optimized(df, capsys) -> str:
    text = _explain(df, capsys)
    return text.split("== Optimized Logical Plan ==", 1)[1].split("== Physical Plan ==", 1)[0]


def test_json_is_parsed_once_per_record(spark, capsys):
    bronze = readings.parse_envelope(registry.envelope_log(registry.meter_readings(spark, SF_SMALL)))
    gold = windows.gold(readings.silver(bronze), watermark=None)
    assert _optimized(gold, capsys).count("from_json(") == 1


def test_staging_scan_reads_only_needed_columns(spark, capsys):
    df = registry.consumption_by_type(spark, SF_SMALL)
    plan = _plan(df, capsys)
    assert "props" not in plan and "event_type" not in plan


def test_preview_is_a_top_k_not_a_sort(spark, capsys):
    assert "TakeOrderedAndProject" in _plan(registry.gold_preview(spark, SF_SMALL), capsys)


def test_state_zone_join_sees_one_row_per_hour_and_zone(spark, capsys):
    m = registry.models(spark, SF_SMALL)
    plan = _optimized(reports.zone_hour_rank(m.fact, m.dim_grid_zones), capsys)
    join = plan.index("Join Inner")
    assert "Aggregate [consumption_hour" in plan[join:] and "ResolvedHint" not in plan


def test_native_time_filter_reaches_the_scan(spark, capsys):
    staged = registry.models(spark, SF_SMALL).staging
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    plan = _plan(staged.where(F.col("event_timestamp") >= cut), capsys)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


def test_aggregates_are_partial_before_the_shuffle(spark, capsys):
    plan = _plan(registry.models(spark, SF_SMALL).hourly, capsys)
    assert "partial_sum" in plan and "partial_count" in plan


def test_high_water_mark_reads_no_column_data_for_the_newest_day(spark, tmp_dir, capsys):
    from meterlake.plans import materialize

    target = f"{tmp_dir}/fact"
    materialize.incremental_fact(spark, registry.models(spark, SF_SMALL).staging, target)
    t = spark.read.parquet(target)
    plan = _plan(t.select(F.max(materialize.FACT_PARTITION)), capsys)
    assert "ReadSchema: struct<>" in plan


def test_upsert_prunes_untouched_partitions_at_run_time(spark, tmp_dir, capsys):
    from meterlake.plans import materialize

    target = f"{tmp_dir}/fact"
    materialize.incremental_fact(spark, registry.models(spark, SF_SMALL).staging, target)
    touched = spark.createDataFrame([("2024-01-30",)], "d string").selectExpr(
        f"cast(d as date) as {materialize.FACT_PARTITION}"
    )
    plan = _plan(spark.read.parquet(target).join(touched, materialize.FACT_PARTITION, "left_semi"), capsys)
    assert "dynamicpruningexpression" in plan or "PartitionFilters: [isnotnull(consumption_date" in plan


def test_state_filter_reaches_a_stored_fact_scan(spark, tmp_dir, capsys):
    m = registry.models(spark, SF_SMALL)
    m.fact.write.parquet(f"{tmp_dir}/fact")
    plan = _plan(reports.zone_hour_rank(spark.read.parquet(f"{tmp_dir}/fact"), m.dim_grid_zones, built_in_states=True), capsys)
    assert "PushedFilters: [In(grid_zone, [NRW-North,NRW-South])" in plan


def _scans(plan: str) -> int:
    return plan.count("FileScan parquet")


def test_the_source_suite_reads_its_table_once(spark, capsys):
    assert _scans(_plan(registry.dq_source_suite(spark, SF_SMALL), capsys)) == 1


def test_the_mart_suite_reads_the_readings_no_more(spark, capsys):
    plan = _plan(registry.dq_mart_suite(spark, SF_SMALL), capsys)
    # The fact twice (one fold, one unique check), each dimension once.
    assert _scans(plan) == 5 and "events.parquet" not in plan


def test_the_star_join_reads_the_readings_no_more(spark, capsys):
    assert "events.parquet" not in _plan(registry.star_join(spark, SF_SMALL), capsys)
