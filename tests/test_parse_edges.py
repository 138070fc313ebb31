"""Hand-computed edge rows for the bronze parse and the silver filter."""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.sql import functions as F

from meterlake.operators import marts, readings, windows
from meterlake.schemas import ENVELOPE_SCHEMA

BASE = {
    "meter_id": "METER-0001",
    "timestamp": "2026-05-20T09:15:32.123456Z",
    "kwh_reading": 1.5,
    "voltage": 230.0,
    "frequency": 50.0,
    "grid_zone": "Bavaria",
    "meter_type": "residential",
    "is_anomaly": False,
}


def _msg(**changes):
    d = dict(BASE)
    d.update(changes)
    return json.dumps(d)


def _envelope(spark, payloads):
    t0 = dt.datetime(2026, 5, 20, 9, 16)
    rows = [
        (None, None if p is None else p.encode(), "t", 0, i, t0, 0) for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def _bronze(spark, payloads):
    return readings.parse_envelope(_envelope(spark, payloads), lambda: F.col("kafka_ts"))


def test_valid_reading_parses_all_fields(spark):
    row = _bronze(spark, [_msg()]).collect()[0]
    assert row.meter_id == "METER-0001"
    assert row.kwh_reading == 1.5 and row.voltage == 230.0 and row.frequency == 50.0
    assert row.grid_zone == "Bavaria" and row.meter_type == "residential" and row.is_anomaly is False
    # session time zone is UTC; the parsed instant is 09:15:32.123456 UTC
    assert row.event_timestamp == dt.datetime(2026, 5, 20, 9, 15, 32, 123456)


def test_malformed_empty_and_null_payloads_give_null_rows(spark):
    rows = _bronze(spark, ["not json", "", None]).collect()
    assert len(rows) == 3
    for r in rows:
        assert all(r[c] is None for c in BASE)
    assert readings.silver(_bronze(spark, ["not json", "", None])).count() == 0


def test_bad_timestamp_is_null_and_does_not_raise(spark):
    b = _bronze(spark, [_msg(timestamp="garbage")])
    row = b.collect()[0]
    assert row.event_timestamp is None and row.meter_id == "METER-0001"
    s = readings.silver(b)
    assert s.count() == 1  # silver does not check the event time
    assert windows.gold(s, watermark=None).count() == 0  # no window for NULL time
    hourly = marts.hourly_consumption(readings.staging(s.drop("timestamp")))
    assert hourly.collect()[0].consumption_hour is None


def test_wrong_typed_field_nulls_that_field_only(spark):
    row = _bronze(spark, ['{"meter_id":"M","kwh_reading":"abc","voltage":230.0,"frequency":50.0}']).collect()[0]
    assert row.kwh_reading is None and row.meter_id == "M" and row.voltage == 230.0


def test_nan_passes_and_poisons_aggregates(spark):
    payload = _msg().replace('"kwh_reading": 1.5', '"kwh_reading": NaN')
    b = _bronze(spark, [payload, _msg()])
    s = readings.silver(b)
    assert s.count() == 2
    g = windows.gold(s, watermark=None).collect()[0]
    assert math.isnan(g.avg_kwh) and math.isnan(g.max_kwh) and math.isnan(g.total_kwh)


def test_unknown_field_ignored(spark):
    d = json.loads(_msg())
    d["firmware"] = "1.2"
    assert readings.silver(_bronze(spark, [json.dumps(d)])).count() == 1


def test_bounds_are_inclusive_and_nulls_rejected(spark):
    keep = [_msg(voltage=200.0), _msg(voltage=260.0), _msg(frequency=49.0), _msg(frequency=51.0), _msg(kwh_reading=0.0)]
    drop = [
        _msg(voltage=199.9), _msg(voltage=260.1), _msg(frequency=48.99), _msg(frequency=51.01),
        _msg(kwh_reading=-0.0001), _msg(voltage=None), _msg(meter_id=None), _msg(kwh_reading=None),
        _msg(frequency=None),
    ]
    assert readings.silver(_bronze(spark, keep)).count() == len(keep)
    assert readings.silver(_bronze(spark, drop)).count() == 0


def test_null_anomaly_is_kept_counts_zero_and_is_no_alert(spark):
    s = readings.silver(_bronze(spark, [_msg(is_anomaly=None), _msg(is_anomaly=True)]))
    assert s.count() == 2
    g = windows.gold(s, watermark=None).collect()[0]
    assert g.anomaly_count == 1
    staged = readings.staging(s)
    assert readings.anomaly_alerts(staged).count() == 1


def test_unknown_zone_kept_with_null_names(spark):
    s = readings.staging(readings.silver(_bronze(spark, [_msg(grid_zone="Berlin")])))
    z = marts.dim_grid_zones(s).collect()[0]
    assert z.grid_zone == "Berlin" and z.grid_zone_name is None and z.federal_state is None


def test_zone_change_within_hour_duplicates_key(spark):
    s = readings.staging(
        readings.silver(_bronze(spark, [_msg(), _msg(grid_zone="Saxony", timestamp="2026-05-20T09:40:00Z")]))
    )
    fact = marts.fact_consumption(marts.hourly_consumption(s))
    rows = fact.collect()
    assert len(rows) == 2 and rows[0].consumption_id == rows[1].consumption_id


def test_duplicate_readings_are_not_deduplicated(spark):
    assert readings.silver(_bronze(spark, [_msg(), _msg()])).count() == 2


def test_event_hubs_record_maps_to_envelope(spark):
    from meterlake.sources.log import from_event_hubs

    eh = spark.createDataFrame(
        [(bytearray(_msg().encode()), dt.datetime(2026, 5, 20, 9, 16))], "body binary, enqueuedTime timestamp"
    )
    row = readings.parse_envelope(from_event_hubs(eh)).collect()[0]
    assert row.meter_id == "METER-0001" and row.kafka_ts == dt.datetime(2026, 5, 20, 9, 16)


def test_surrogate_key_text_is_pinned(spark):
    from meterlake.functions.keys import surrogate_key
    from pyspark.sql import types as T

    df = spark.createDataFrame(
        [("M1", dt.datetime(2024, 1, 1, 5)), (None, None)], "m string, h timestamp_ntz"
    )
    got = df.select(surrogate_key("m", "h", types=[None, T.TimestampNTZType()]).alias("k")).collect()
    import hashlib

    assert got[0].k == hashlib.md5(b"M1-2024-01-01 05:00:00.000").hexdigest()
    null = "_dbt_utils_surrogate_key_null_"
    assert got[1].k == hashlib.md5(f"{null}-{null}".encode()).hexdigest()


def test_alert_and_keyed_message_shapes(spark):
    staged_like = spark.createDataFrame(
        [("M1", dt.datetime(2024, 1, 1, 5, 0, 0), 2.0, 230.0, 50.0, "Saxony", "industrial", True)],
        "meter_id string, event_timestamp timestamp_ntz, kwh_reading double, voltage double, frequency double,"
        " grid_zone string, meter_type string, is_anomaly boolean",
    )
    alert = readings.alert_messages(staged_like).collect()[0]
    assert alert.asDict() == {
        "meter_id": "M1", "timestamp": "2024-01-01T05:00:00Z", "kwh": 2.0, "grid_zone": "Saxony",
        "alert_type": "CONSUMPTION_SPIKE",
    }
    msg = readings.keyed_messages(staged_like).collect()[0]
    assert msg.key == "M1"
    assert json.loads(msg.value)["timestamp"] == "2024-01-01T05:00:00Z"


def test_null_event_time_gives_one_null_date_row_that_fails_its_check(spark):
    from meterlake.operators import quality

    staged = readings.staging(readings.silver(_bronze(spark, [_msg(timestamp="garbage"), _msg()])))
    dates = marts.dim_dates(staged)
    assert dates.count() == 2 and dates.where("date_hour is null").count() == 1
    res = quality.evaluate({"dim_dates": dates}, [quality.Check("dim_dates", "date_hour", "not_null")]).first()
    assert res.failures == 1


def test_null_zone_forms_its_own_group(spark):
    staged = readings.staging(readings.silver(_bronze(spark, [_msg(grid_zone=None), _msg(grid_zone=None, meter_id="M2"), _msg()])))
    zones = {r.grid_zone: r.meter_count for r in marts.dim_grid_zones(staged).collect()}
    assert zones == {None: 2, "Bavaria": 1}
