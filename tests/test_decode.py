"""Golden envelopes and timestamps."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.sources import envelope
from meteoframe.streaming.sources import decode_stream


def env(reading=None, **data):
    d = {"reading_id": "r1", "device_id": "d1", "created_at": "2024-05-01T00:00:00.000Z",
         "reading": {"valid": True, "uv_index": 3, "rain_gauge": 1, "wind_speed": 2,
                     "air_humidity": 50, "peak_wind_gust": 3.5, "air_temperature": 21.5,
                     "light_intensity": 10, "rain_accumulation": 0.5,
                     "barometric_pressure": 100000, "wind_direction_sensor": 90}}
    if reading:
        d["reading"].update(reading)
    d.update(data)
    return json.dumps({"message": "ok", "success": True, "data": d})


def decode(spark, values, mode=P.AS_WRITTEN):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return envelope.decode_readings(df, "value", mode).collect()


def test_well_formed(spark):
    (r,) = decode(spark, [env()])
    assert r.reading_id == "r1" and r.valid is True
    assert r.uv_index == 3.0 and isinstance(r.uv_index, float)
    assert r.air_humidity == 50 and r.barometric_pressure == 100000
    assert r.processing_timestamp == dt.datetime(2024, 5, 1)


@pytest.mark.parametrize("bad", [3.5, 3.0, "4"])
def test_int_field_with_other_json_type_is_null(spark, bad):
    (r,) = decode(spark, [env({"uv_index": bad})])
    assert r.uv_index is None and r.air_temperature == 21.5


def test_double_field_accepts_int_and_nan_text(spark):
    (a,) = decode(spark, [env({"air_temperature": 20})])
    assert a.air_temperature == 20.0
    (b,) = decode(spark, [env({"air_temperature": "NaN"})])
    assert b.air_temperature != b.air_temperature


def test_boolean_text_is_null(spark):
    (r,) = decode(spark, [env({"valid": "true"})])
    assert r.valid is None


def test_unknown_field_ignored(spark):
    (r,) = decode(spark, [env({"extra": 1}, other="x")])
    assert r.reading_id == "r1"


@pytest.mark.parametrize("text", ["not json", "null", '{"message": "m"}', '{"data": [1, 2]}'])
def test_unusable_text_gives_all_null_row(spark, text):
    (r,) = decode(spark, [text])
    assert all(v is None for v in r.asDict().values())


def test_sql_null_gives_all_null_row(spark):
    (r,) = decode(spark, [None])
    assert all(v is None for v in r.asDict().values())


@pytest.mark.parametrize("text", ["2024-05-01T00:00:00Z", "2024-05-01T00:00:00.000001Z", "x"])
def test_bad_timestamp_raises_as_written_null_corrected(spark, text):
    with pytest.raises(PySparkException):
        decode(spark, [env(created_at=text)])
    (r,) = decode(spark, [env(created_at=text)], P.CORRECTED)
    assert r.processing_timestamp is None and r.reading_id == "r1"


def test_null_timestamp_is_null(spark):
    (r,) = decode(spark, [env(created_at=None)])
    assert r.processing_timestamp is None


def test_timestamp_read_in_session_zone_utc(spark):
    (r,) = decode(spark, [env(created_at="2024-05-01T12:34:56.789Z")])
    ts = spark.createDataFrame([(r.processing_timestamp,)], "t timestamp")
    assert ts.select(F.unix_timestamp("t")).first()[0] == 1714566896


def test_encode_decode_round_trip(spark):
    flat = envelope.decode_readings(spark.createDataFrame([(env(),)], "value string"))
    again = envelope.decode_readings(envelope.encode_envelope(flat))
    assert again.collect() == flat.collect()


def test_pages_explode_one_envelope_per_reading(spark):
    page = json.dumps({"message": "m", "success": True,
                       "data": [json.loads(env())["data"], json.loads(env())["data"] | {"reading_id": "r2"}]})
    out = envelope.explode_pages(spark.createDataFrame([(page,)], "value string"))
    rows = out.select("message", "success", "data.reading_id").collect()
    assert [(r.message, r.success, r.reading_id) for r in rows] == [("m", True, "r1"), ("m", True, "r2")]


def test_decode_stream_keeps_raw_text(spark):
    df = spark.createDataFrame([(bytearray(env().encode()),)], "value binary")
    r = decode_stream(df).first()
    assert r["_raw"] == env() and r.reading_id == "r1"


def test_decode_schema_prunes_envelope_fields(spark):
    df = envelope.decode_envelope(spark.createDataFrame([(env(),)], "value string"))
    assert df.columns == ["reading_id", "device_id", "reading", "created_at"]
