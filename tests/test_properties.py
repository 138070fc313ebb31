"""Property tests: Spark expressions against plain-Python restatements."""

from __future__ import annotations

import datetime as dt
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions.keys import surrogate_key
from meterlake.functions.text import iso_utc_text
from meterlake.functions.validation import valid_reading
from meterlake.operators import marts, windows
from meterlake.plans import materialize

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe_double = st.one_of(st.none(), st.floats(min_value=-10, max_value=300, allow_nan=False))
reading = st.tuples(st.one_of(st.none(), st.just("M1")), maybe_double, maybe_double, maybe_double)


def _valid(meter, kwh, volt, freq):
    return (
        meter is not None
        and kwh is not None
        and kwh >= 0
        and volt is not None
        and 200 <= volt <= 260
        and freq is not None
        and 49 <= freq <= 51
    )


@SETTINGS
@given(st.lists(reading, min_size=1, max_size=30))
def test_validation_rule_matches_definition(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, meter_id string, kwh_reading double, voltage double, frequency double",
    )
    kept = {r.i for r in df.where(valid_reading()).select("i").collect()}
    assert kept == {i for i, r in enumerate(rows) if _valid(*r)}


instants = st.datetimes(min_value=dt.datetime(2020, 1, 1), max_value=dt.datetime(2030, 1, 1))


@SETTINGS
@given(st.lists(instants, min_size=1, max_size=30))
def test_window_is_five_minute_floor(spark, times):
    df = spark.createDataFrame(
        [("M1", t, 1.0, 230.0, 50.0, "Bavaria", "industrial", False) for t in times],
        "meter_id string, event_timestamp timestamp_ntz, kwh_reading double, voltage double,"
        " frequency double, grid_zone string, meter_type string, is_anomaly boolean",
    )
    got = {(r.window_start, r.meter_count) for r in windows.gold(df, watermark=None).collect()}
    expected: dict[dt.datetime, int] = {}
    for t in times:
        start = t.replace(minute=t.minute - t.minute % 5, second=0, microsecond=0)
        expected[start] = expected.get(start, 0) + 1
    assert got == set(expected.items())


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(min_size=1, max_size=8)), st.one_of(st.none(), instants)), min_size=1, max_size=20))
def test_surrogate_key_and_iso_text(spark, rows):
    df = spark.createDataFrame(rows, "m string, h timestamp_ntz")
    out = df.select(
        surrogate_key("m", "h", types=[None, T.TimestampNTZType()]).alias("k"),
        iso_utc_text(F.col("h")).alias("iso"),
    ).collect()
    null = "_dbt_utils_surrogate_key_null_"
    for (m, h), r in zip(rows, out):
        h_text = h.strftime("%Y-%m-%d %H:%M:%S.") + f"{h.microsecond // 1000:03d}" if h else null
        assert r.k == hashlib.md5(f"{m if m is not None else null}-{h_text}".encode()).hexdigest()
        assert r.iso == (None if h is None else h.isoformat() + "Z")


hour_rows = st.lists(st.tuples(st.integers(0, 47), st.integers(0, 59), st.floats(0, 10, allow_nan=False)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hour_rows, st.integers(0, 47 * 60))
def test_two_run_fold_matches_definition(spark, tmp_dir, rows, cut_minute):
    """First run over readings before the cut, second over all: the result is
    the first run's hours plus every later hour than its newest."""
    base = dt.datetime(2024, 1, 1)
    readings = [(base + dt.timedelta(hours=h, minutes=m), kwh) for h, m, kwh in rows]
    cut = base + dt.timedelta(minutes=cut_minute)
    df = spark.createDataFrame(
        [("M1", t, kwh, 230.0, 50.0, "Bavaria", "industrial", False, t, t) for t, kwh in readings],
        "meter_id string, event_timestamp timestamp_ntz, kwh_reading double, voltage double, frequency double,"
        " grid_zone string, meter_type string, is_anomaly boolean, ingest_timestamp timestamp_ntz,"
        " processed_timestamp timestamp_ntz",
    )
    target = f"{tmp_dir}/fact-{cut_minute}-{len(rows)}-{abs(hash(tuple(rows)))}"
    materialize.incremental_fact(spark, df.where(F.col("event_timestamp") < F.lit(cut).cast("timestamp_ntz")), target)
    materialize.incremental_fact(spark, df, target)
    schema = materialize.with_partition(marts.fact_consumption(marts.hourly_consumption(df))).schema
    got = {(r.consumption_hour, r.reading_count) for r in materialize.read_fact(spark, target, schema).collect()}

    def hourly(items):
        out: dict[dt.datetime, int] = {}
        for t, _ in items:
            h = t.replace(minute=0, second=0, microsecond=0)
            out[h] = out.get(h, 0) + 1
        return out

    first = hourly([r for r in readings if r[0] < cut])
    full = hourly(readings)
    # An empty first run leaves an existing but empty table, whose max hour
    # is NULL: later runs add nothing.
    expected = dict(first)
    if first:
        expected.update({h: n for h, n in full.items() if h > max(first)})
    assert got == set(expected.items())
