"""Every check kind on a passing and a failing table; the gate."""

from __future__ import annotations

import pytest

from meterlake.operators import quality
from meterlake.operators.quality import Check


def _eval(df, checks):
    return {(r.column_name, r.check_type): r.failures for r in quality.evaluate({"t": df}, checks).collect()}


def test_not_null_counts_null_rows(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "meter_id string")
    assert _eval(df, [Check("t", "meter_id", "not_null")]) == {("meter_id", "not_null"): 2}


def test_null_zone_fails_not_null_but_passes_accepted_values(spark):
    df = spark.createDataFrame([("Bavaria",), (None,)], "grid_zone string")
    res = _eval(df, [Check("t", "grid_zone", "not_null"), Check("t", "grid_zone", "accepted_values", quality.ZONES)])
    assert res == {("grid_zone", "not_null"): 1, ("grid_zone", "accepted_values"): 0}


def test_accepted_values_counts_distinct_bad_values(spark):
    df = spark.createDataFrame([("Berlin",), ("Berlin",), ("Bavaria",)], "grid_zone string")
    assert _eval(df, [Check("t", "grid_zone", "accepted_values", quality.ZONES)]) == {("grid_zone", "accepted_values"): 1}
    df = spark.createDataFrame([("other",), ("residential",)], "meter_type string")
    assert _eval(df, [Check("t", "meter_type", "accepted_values", quality.TYPES)]) == {("meter_type", "accepted_values"): 1}


def test_unique_reports_duplicates_not_nulls(spark):
    df = spark.createDataFrame([("k1",), ("k1",), ("k2",), (None,), (None,)], "consumption_id string")
    assert _eval(df, [Check("t", "consumption_id", "unique")]) == {("consumption_id", "unique"): 1}
    rows = quality.failing_rows(df, Check("t", "consumption_id", "unique")).collect()
    assert [(r.unique_field, r.n_records) for r in rows] == [("k1", 2)]


def test_null_date_hour_fails(spark):
    df = spark.createDataFrame([(None,)], "date_hour timestamp_ntz")
    assert _eval(df, [Check("t", "date_hour", "not_null"), Check("t", "date_hour", "unique")]) == {
        ("date_hour", "not_null"): 1,
        ("date_hour", "unique"): 0,
    }


def test_suites_have_twenty_checks():
    assert len(quality.SOURCE_SUITE) == 6 and len(quality.MART_SUITE) == 14


def test_gate_raises_on_failure_and_passes_clean(spark):
    bad = spark.createDataFrame([(None,)], "meter_id string")
    with pytest.raises(quality.DataQualityError):
        quality.gate(quality.evaluate({"t": bad}, [Check("t", "meter_id", "not_null")]))
    good = spark.createDataFrame([("a",)], "meter_id string")
    quality.gate(quality.evaluate({"t": good}, [Check("t", "meter_id", "not_null")]))


def test_run_then_test_builds_and_gates(spark, tmp_dir):
    from meterlake.plans import job
    from meterlake.sources.fixtures import meter_readings

    source = meter_readings(spark, "/root/testdata/sf0.001")
    with pytest.raises(quality.DataQualityError):  # the fixture has NULL meter ids
        job.run_then_test(spark, source, f"{tmp_dir}/a")
    clean = source.where("meter_id is not null and kwh_reading is not null")
    result = job.run_then_test(spark, clean, f"{tmp_dir}/b")
    assert result.fact_run.mode == "full" and result.checks.count() == 20
    assert spark.table("stg_meter_readings").count() == 936


def test_one_scan_marts_equal_direct_marts(spark):
    from meterlake.operators import marts
    from meterlake.plans.models import Models
    from meterlake.sources.fixtures import meter_readings

    m = Models(meter_readings(spark, "/root/testdata/sf0.01"))
    mh = marts.meter_hours(m.staging)
    pairs = [
        (marts.dim_meters(m.staging), marts.dim_meters_from_meter_hours(mh)),
        (marts.dim_grid_zones(m.staging), marts.dim_grid_zones_from_meter_hours(mh)),
        (marts.dim_dates(m.staging), marts.dim_dates_from_meter_hours(mh)),
        (m.hourly.drop("total_kwh", "avg_kwh"), marts.hourly_from_meter_hours(mh).drop("total_kwh", "avg_kwh")),
    ]
    for direct, derived in pairs:
        assert direct.exceptAll(derived).count() == 0 and derived.exceptAll(direct).count() == 0


def test_marts_answer_sql_by_model_name(spark, tmp_dir):
    """SQL written against the model names runs on the built marts, also
    from a fresh registration of the folders."""
    from meterlake.operators import reports
    from meterlake.plans import catalog, job
    from meterlake.sources.fixtures import meter_readings

    source = meter_readings(spark, "/root/testdata/sf0.001")
    result = job.run_then_test(spark, source, f"{tmp_dir}/marts", fail_on_error=False)
    catalog.register_marts(spark, f"{tmp_dir}/marts")
    by_sql = spark.sql(
        """
        select f.meter_type, sum(f.reading_count) as reading_count, count(distinct z.federal_state) as states
        from fct_energy_consumption f join dim_grid_zones z using (grid_zone)
        group by f.meter_type
        """
    )
    by_df = reports.consumption_by_type(result.tables["fct_energy_consumption"])
    got = {r.meter_type: r.reading_count for r in by_sql.collect()}
    assert got == {r.meter_type: r.reading_count for r in by_df.collect()}
    assert sum(got.values()) == 936
