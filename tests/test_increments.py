"""Deliveries: totals, dimensions, fact and checks by parts; publishing by manifest."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake import files
from meterlake.functions.numbering import gapless, with_local_number
from meterlake.operators import check_state, marts, quality
from meterlake.operators.quality import Check
from meterlake.plans import increments, registry
from meterlake.plans.increments import FACT, METERS, ZONES, DuplicateKeys, Warehouse
from meterlake.plans.models import Models
from meterlake.sinks import dated
from meterlake.sinks.manifest import CommitConflict, Manifest
from meterlake.sources.fixtures import EVENTS_SCHEMA, meter_readings
from tests.conftest import SF_SMALL

SCHEMA = (
    "meter_id string, event_timestamp timestamp_ntz, kwh_reading double, voltage double, frequency double,"
    " grid_zone string, meter_type string, is_anomaly boolean, ingest_timestamp timestamp_ntz,"
    " processed_timestamp timestamp_ntz"
)


def rows(spark, items, zone="Bavaria"):
    made = [(m, t, kwh, 230.0, 50.0, zone, "residential", False, t, t) for m, t, kwh in items]
    return spark.createDataFrame(made, SCHEMA)


def T(h, m=0, day=1):
    return dt.datetime(2024, 1, day, h, m)


def same(a, b):
    digits = lambda df: df.select(*[F.round(F.col(f.name) + 1e-9, 6).alias(f.name) if f.dataType.typeName() == "double" else f.name
                                    for f in sorted(df.schema.fields, key=lambda f: f.name)])
    a, b = digits(a), digits(b)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def deliveries(source):
    odd = F.coalesce(F.hour("event_timestamp") % 2 == 1, F.lit(False))
    return [("even", source.where(~odd)), ("odd", source.where(odd))]


@pytest.mark.parametrize("variant", ["edge", "zone_flip"])
def test_deliveries_merged_equal_a_whole_build(spark, tmp_dir, variant):
    source = meter_readings(spark, SF_SMALL, variant)
    store = Warehouse(spark, f"{tmp_dir}/w", late="merge")
    for name, part in deliveries(source):
        run = store.apply(part, name, gate=False)
    whole = Models(source)
    for name, df in whole.marts().items():
        assert same(store.tables()[name], df), name
    want = quality.evaluate({"meter_readings": source, **whole.marts()}, quality.SOURCE_SUITE + quality.MART_SUITE)
    assert same(run.checks, want)


def test_a_second_delivery_reads_itself_only(spark, tmp_dir):
    """The first delivery's readings are gone when the second one comes."""
    source = meter_readings(spark, SF_SMALL).where("meter_id is not null and kwh_reading is not null")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    store = Warehouse(spark, f"{tmp_dir}/w")
    for k, part in enumerate((source.where(F.col("event_timestamp") < cut), source.where(F.col("event_timestamp") >= cut))):
        part.write.parquet(f"{tmp_dir}/in{k}")
        run = store.apply(spark.read.parquet(f"{tmp_dir}/in{k}"), f"d{k}")
        files.delete(spark, f"{tmp_dir}/in{k}")
    assert run.mode == "incremental" and run.published
    assert same(store.tables()[FACT], Models(source).fact)
    # The hours beyond the mark come from the second part's files alone.
    state = store.manifest.current()[1]
    mark = F.lit(run.high_water_mark).cast("timestamp_ntz")
    beyond = store.hours(state).where((F.col("consumption_date") >= F.to_date(mark)) & (F.col("consumption_hour") > mark))
    assert beyond.count() > 0
    assert all(state["hours"][1]["folder"] in r[0] for r in beyond.select(F.input_file_name()).distinct().collect())


def test_late_hours_are_ignored_or_merged(spark, tmp_dir):
    first = [("M1", T(1), 1.0), ("M1", T(2, 10), 2.0)]
    second = [("M1", T(2, 40), 5.0), ("M2", T(3, 5), 7.0), ("M1", T(0, 5), 9.0)]
    got = {}
    for late in ("ignore", "merge"):
        store = Warehouse(spark, f"{tmp_dir}/{late}", late=late)
        assert store.apply(rows(spark, first), "a").mode == "full"
        store.apply(rows(spark, second), "b")
        got[late] = {(r.meter_id, r.consumption_hour.hour): r.total_kwh for r in store.tables()[FACT].collect()}
    assert got["ignore"] == {("M1", 1): 1.0, ("M1", 2): 2.0, ("M2", 3): 7.0}
    assert got["merge"] == {("M1", 0): 9.0, ("M1", 1): 1.0, ("M1", 2): 7.0, ("M2", 3): 7.0}


def test_a_delivery_counts_once(spark, tmp_dir):
    store = Warehouse(spark, f"{tmp_dir}/w")
    store.apply(rows(spark, [("M1", T(1), 1.0)]), "a")
    again = store.apply(rows(spark, [("M1", T(1), 1.0)]), "a")
    assert again.mode == "repeated" and not again.published
    assert store.tables()[METERS].first().total_readings == 1


def test_a_failing_gate_leaves_the_old_marts(spark, tmp_dir):
    store = Warehouse(spark, f"{tmp_dir}/w")
    store.apply(rows(spark, [("M1", T(1), 1.0)]), "a")
    views = store.register()
    bad = rows(spark, [("M2", T(5), 1.0)]).union(rows(spark, [(None, T(5), 1.0)]))
    with pytest.raises(quality.DataQualityError):
        store.apply(bad, "b")
    assert views[FACT].count() == spark.table(FACT).count() == store.tables()[FACT].count() == 1
    assert store.tables()[METERS].count() == 1
    # The mended delivery is taken as if the failed one had not been.
    store.apply(rows(spark, [("M2", T(5), 1.0)]), "b")
    assert store.register()[FACT].count() == 2
    gone = store.vacuum(keep=1)
    assert gone and store.tables()[FACT].count() == 2


def test_a_check_that_warns_is_reported_and_stops_nothing(spark, tmp_dir):
    twice = rows(spark, [("M1", T(1), 1.0)]).union(rows(spark, [("M1", T(1, 30), 2.0)], "Saxony"))
    with pytest.raises(quality.DataQualityError, match="unique"):
        Warehouse(spark, f"{tmp_dir}/strict").apply(twice, "a")
    store = Warehouse(spark, f"{tmp_dir}/w")
    run = store.apply(twice, "a", warn=[increments.FACT_KEY])
    assert run.published and store.tables()[FACT].count() == 2
    assert [(r.model, r.check_type) for r in run.checks.where("failures > 0").collect()] == [(FACT, "unique")]
    with pytest.raises(quality.DataQualityError, match="1 check.*meter_id not_null"):
        store.apply(rows(spark, [(None, T(5), 1.0)]), "b", warn=[increments.FACT_KEY])


def test_publish_outcome_with_keys_that_several_zones_share(spark, tmp_dir):
    """Meter numbers of five digits share their first four: three zones and types."""
    events = [(k, dt.datetime(2024, 1, 10 + 10 * (k > 5), 3, k), 12340 + k % 3, "view", 5.0 + k, "{}") for k in (1, 2, 3, 4, 6, 7, 8, 9)]
    events.append((103, dt.datetime(2024, 1, 25), 7, "view", 1.0, "{}"))  # a reading without a meter
    spark.createDataFrame(events, EVENTS_SCHEMA).write.parquet(f"{tmp_dir}/events.parquet")
    got = [tuple(r) for r in registry.publish_outcome(spark, tmp_dir).orderBy("step").collect()]
    assert got == [(1, "full", 3, 4), (2, "stopped", 3, 4), (3, "incremental", 6, 8)]


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_dir, monkeypatch):
    store = Warehouse(spark, f"{tmp_dir}/w")
    store.apply(rows(spark, [("M1", T(1), 1.0)]), "a")
    monkeypatch.setattr(Manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    for change in (lambda: store.apply(rows(spark, [("M1", T(4), 4.0)]), "b"), lambda: store.upsert(store.tables()[FACT])):
        with pytest.raises(RuntimeError):
            change()
    monkeypatch.undo()
    assert [r.total_kwh for r in store.tables()[FACT].collect()] == [1.0]
    store.apply(rows(spark, [("M1", T(4), 4.0)]), "b")
    assert sorted(r.total_kwh for r in store.tables()[FACT].collect()) == [1.0, 4.0]


def test_only_one_of_two_runs_commits(spark, tmp_dir):
    manifest = Manifest(spark, f"{tmp_dir}/m")
    assert manifest.current() == (0, {})
    assert manifest.commit(0, {"a": 1}) == 1
    with pytest.raises(CommitConflict):
        manifest.commit(0, {"a": 2})
    assert manifest.current() == (1, {"a": 1})


def test_empty_deliveries(spark, tmp_dir):
    store = Warehouse(spark, f"{tmp_dir}/w")
    none = rows(spark, []).limit(0)
    assert store.apply(none, "a").mode == "full"
    assert store.tables()[FACT].count() == 0
    # The fact exists but is empty: nothing is ever after its newest hour.
    assert store.apply(rows(spark, [("M1", T(1), 1.0)]), "b").mode == "skipped"
    assert store.tables()[FACT].count() == 0 and store.tables()[METERS].count() == 1
    assert store.apply(none, "c", full_refresh=True).mode == "full"
    assert store.tables()[FACT].count() == 1


def test_upsert_by_manifest(spark, tmp_dir):
    store = Warehouse(spark, f"{tmp_dir}/w")
    store.apply(rows(spark, [("M1", T(1), 1.0), ("M1", T(2), 2.0), ("M1", T(1, day=2), 9.0), ("M3", None, 3.0)]), "a", gate=False)
    before = store.manifest.current()[1]["fact"][0]["folder"]
    updates = marts.fact_consumption(marts.hourly_consumption(rows(spark, [("M1", T(2), 20.0), ("M1", T(5), 5.0)])))
    store.upsert(updates)
    got = {(r.consumption_hour and (r.consumption_hour.day, r.consumption_hour.hour)): r.total_kwh for r in store.tables()[FACT].collect()}
    assert got == {(1, 1): 1.0, (1, 2): 20.0, (1, 5): 5.0, (2, 1): 9.0, None: 3.0}
    entries = store.manifest.current()[1]["fact"]
    assert [e["folder"] for e in entries][0] == before and entries[0]["dates"] == ["2024-01-02", dated.NO_DATE]
    with pytest.raises(DuplicateKeys, match="1 key"):
        store.upsert(updates.union(updates.where("total_kwh > 10")))
    assert store.tables()[FACT].count() == 5


def test_upsert_takes_all_rows_of_a_repeated_key(spark, tmp_dir):
    """A meter in two zones inside an hour has two fact rows with one key: both
    are replaced by the key's updates. The same row twice is still refused."""
    store = Warehouse(spark, f"{tmp_dir}/w")
    old = rows(spark, [("M1", T(1), 1.0), ("M1", T(2), 2.0)]).union(rows(spark, [("M1", T(2, 30), 3.0), ("M2", T(2), 4.0)], "Saxony"))
    store.apply(old, "a", gate=False)
    late = rows(spark, [("M1", T(2, 10), 20.0)]).union(rows(spark, [("M1", T(2, 50), 30.0)], "Saxony")).union(rows(spark, [("M1", T(2, 55), 40.0)], "Hamburg"))
    updates = marts.fact_consumption(marts.hourly_consumption(late))
    assert updates.select("consumption_id").distinct().count() == 1
    store.upsert(updates)
    got = {(r.meter_id, r.consumption_hour.hour, r.grid_zone): r.total_kwh for r in store.tables()[FACT].collect()}
    assert got == {("M1", 1, "Bavaria"): 1.0, ("M1", 2, "Bavaria"): 20.0, ("M1", 2, "Saxony"): 30.0, ("M1", 2, "Hamburg"): 40.0, ("M2", 2, "Saxony"): 4.0}
    with pytest.raises(DuplicateKeys, match="1 key"):
        store.upsert(updates.union(updates))
    assert store.tables()[FACT].count() == 5


def test_compaction_keeps_the_rows_and_bounds_the_parts(spark, tmp_dir):
    store = Warehouse(spark, f"{tmp_dir}/w", late="merge", fan_in=2)
    for k in range(3):
        store.apply(rows(spark, [("M1", T(k), 1.0 + k), (f"M{k}", T(1), 0.5)]), f"d{k}")
    before, n = store.tables()[FACT].collect(), len(store.manifest.current()[1]["hours"])
    number = store.compact()
    state = store.manifest.current()[1]
    assert len(state["hours"]) < n == 3 and store.manifest.current()[0] == number
    assert sorted(map(str, store.tables()[FACT].collect())) == sorted(map(str, before))
    store.apply(rows(spark, [("M1", T(1), 10.0)]), "later")
    late = {(r.meter_id, r.consumption_hour.hour): r.total_kwh for r in store.tables()[FACT].collect()}
    assert late[("M1", 1)] == 2.0 + 0.5 + 10.0
    assert store.compact() >= number and store.vacuum()


def test_zone_counts_come_from_bitmaps(spark, tmp_dir, capsys):
    store = Warehouse(spark, f"{tmp_dir}/w")
    for k in range(2):
        part = rows(spark, [(f"M{i}", T(k, 1), 1.0) for i in range(k, 40_000, 20)])
        store.apply(part.unionByName(rows(spark, [("M0", T(k, 2), 1.0), ("M7", T(k, 2), 1.0)], zone="Hamburg")), f"d{k}", gate=False)
    zones = {r.grid_zone: r.meter_count for r in store.tables()[ZONES].collect()}
    assert zones == {"Bavaria": 4000, "Hamburg": 2}
    store.tables()[ZONES].explain()
    assert "distinct" not in capsys.readouterr().out.lower()


def test_gapless_numbers(spark, tmp_dir):
    made = spark.range(1000).withColumn("g", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3)).repartition(9, "id")
    with_local_number(made).write.parquet(f"{tmp_dir}/t")
    table = spark.read.parquet(f"{tmp_dir}/t")
    assert sorted(r.number for r in gapless(table, 5).collect()) == list(range(5, 1005))
    by_group = {}
    for r in gapless(table, group=["g"]).collect():
        by_group.setdefault(r.g, []).append(r.number)
    assert {g: sorted(n) for g, n in by_group.items()} == {g: list(range(len(n))) for g, n in by_group.items()} and len(by_group) == 4


def test_state_finds_keys_that_parts_share(spark):
    check = Check("t", "k", "unique")
    df = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "1"), ("a", "2"), ("c", "2"), (None, "2")], "k string, d string")
    state = check_state.part_state(df, [check], F.col("d"))
    assert [(r.part, r.value, r.n) for r in state.collect()] == [("1", "b", 2)]
    hashes = check_state.key_hashes(df, "k", "d")
    met = check_state.met_hashes(hashes.where("d = '2'"), hashes.where("d = '1'"))
    state = state.unionByName(check_state.repeated_across(check, met, df))
    assert [r.failures for r in check_state.evaluate_state(state, [check]).collect()] == [2]


def test_merged_parts_add_up(spark):
    source = meter_readings(spark, SF_SMALL)
    staged = Models(source).staging
    parts = [marts.meter_hour_parts(staged.where(F.col("meter_id").substr(-1, 1).isin("1", "3")))]
    parts.append(marts.meter_hour_parts(staged.where(~F.col("meter_id").substr(-1, 1).isin("1", "3"))))
    both = parts[0].unionByName(parts[1])
    assert same(marts.merged_meter_hours(marts.merged_parts(both)), marts.merged_meter_hours(both))
    assert marts.merged_parts(both).columns == parts[0].columns
    assert increments.KINDS
