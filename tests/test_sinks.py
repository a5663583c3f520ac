"""Sink helpers: raw JSON text, type coercion, keyed idempotent writes."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import StructField, StructType, StringType, IntegerType

from meteoframe.sinks import writers
from meteoframe.session import scratch_path
from tests.helpers import flat_df, reading


def test_raw_json_omits_nulls_and_keeps_types(spark):
    df = flat_df(spark, [reading(uv_index=None, air_humidity=5)])
    (row,) = writers.raw_json(df).collect()
    d = json.loads(row.data)
    assert "uv_index" not in d and d["air_humidity"] == 5 and d["reading_id"] == "r1"
    assert d["processing_timestamp"].startswith("2024-05-01T00:00:00")


def test_coerce_write_types(spark):
    df = spark.createDataFrame([("2024-05-01", "2024-05-01 10:00:00")], "date string, processing_timestamp string")
    out = writers.coerce_write_types(df).first()
    assert out.date == dt.date(2024, 5, 1) and out.processing_timestamp == dt.datetime(2024, 5, 1, 10)
    bad = spark.createDataFrame([("nope", None)], "date string, processing_timestamp string")
    with pytest.raises(PySparkException):
        writers.coerce_write_types(bad).collect()
    assert writers.coerce_write_types(bad, strict=False).first().date is None


def test_write_batch_is_idempotent(spark):
    path = scratch_path(spark, "t-sink")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    writers.write_batch(df, path, 0)
    writers.write_batch(df, path, 1)
    writers.write_batch(df, path, 1)
    got = spark.read.parquet(path)
    assert got.count() == 4 and got.filter("batch_id = 1").count() == 2


def test_schema_gaps_case_insensitive():
    actual = StructType([StructField("device_id", StringType()), StructField("qc_tair_range", IntegerType())])
    expected = StructType([StructField("device_id", StringType()), StructField("QC_Tair_range", IntegerType()),
                           StructField("date", StringType())])
    assert writers.schema_gaps(actual, expected) == ["date"]


def test_jdbc_options_have_no_default_credentials():
    o = writers.jdbc_options("jdbc:x://h/db", "t")
    assert o == {"url": "jdbc:x://h/db", "dbtable": "t"}


def test_sizing_rule():
    from meteoframe.session import sizing
    assert sizing(1)["spark.sql.shuffle.partitions"] == "1"
    assert sizing(10 * (128 << 20))["spark.sql.shuffle.partitions"] == "10"
    assert sizing(100 * 10 ** 12)["spark.sql.shuffle.partitions"] == "745059"


def test_schema_gaps_tell_other_kinds_of_type():
    from pyspark.sql.types import StructType
    from meteoframe.sinks import writers
    expected = StructType.fromDDL("a int, b string, c date, d array<string>, e boolean")
    assert writers.schema_gaps(StructType.fromDDL("A decimal(10,2), B varchar(9), c timestamp, d array<string>, e boolean"),
                               expected) == []
    assert writers.schema_gaps(StructType.fromDDL("a string, b string, c date, d string, e int"), expected) == [
        "a (string, not int)", "d (string, not array<string>)", "e (int, not boolean)"]
