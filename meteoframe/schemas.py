"""Declared schemas: envelope on the wire, flat reading, target tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, StringType,
    StructField, StructType, TimestampType,
)

READING_STRUCT = StructType([
    StructField("valid", BooleanType()),
    StructField("uv_index", IntegerType()),
    StructField("rain_gauge", IntegerType()),
    StructField("wind_speed", IntegerType()),
    StructField("air_humidity", IntegerType()),
    StructField("peak_wind_gust", DoubleType()),
    StructField("air_temperature", DoubleType()),
    StructField("light_intensity", IntegerType()),
    StructField("rain_accumulation", DoubleType()),
    StructField("barometric_pressure", IntegerType()),
    StructField("wind_direction_sensor", IntegerType()),
])

DATA_STRUCT = StructType([
    StructField("reading_id", StringType()),
    StructField("device_id", StringType()),
    StructField("reading", READING_STRUCT),
    StructField("created_at", StringType()),
])

ENVELOPE = StructType([
    StructField("message", StringType()),
    StructField("success", BooleanType()),
    StructField("data", DATA_STRUCT),
])

# Only `data` is used downstream; decoding with this narrower schema lets the
# JSON parser skip the other envelope fields.
ENVELOPE_DATA_ONLY = StructType([StructField("data", DATA_STRUCT)])

# API response page: one envelope holding a list of readings.
ENVELOPE_PAGE = StructType([
    StructField("message", StringType()),
    StructField("success", BooleanType()),
    StructField("data", ArrayType(DATA_STRUCT)),
])

# (name, type) of the flat reading, in order; DOUBLE where the flatten casts.
FLAT_READING = StructType([
    StructField("reading_id", StringType()),
    StructField("device_id", StringType()),
    StructField("valid", BooleanType()),
    StructField("uv_index", DoubleType()),
    StructField("rain_gauge", DoubleType()),
    StructField("wind_speed", DoubleType()),
    StructField("air_humidity", IntegerType()),
    StructField("peak_wind_gust", DoubleType()),
    StructField("air_temperature", DoubleType()),
    StructField("light_intensity", IntegerType()),
    StructField("rain_accumulation", DoubleType()),
    StructField("barometric_pressure", IntegerType()),
    StructField("wind_direction_sensor", IntegerType()),
    StructField("processing_timestamp", TimestampType()),
])

MEASURE_COLUMNS = (
    "uv_index", "rain_gauge", "wind_speed", "air_humidity", "peak_wind_gust",
    "air_temperature", "light_intensity", "rain_accumulation", "barometric_pressure",
    "wind_direction_sensor",
)

# Columns kept by cleaning (flat reading without `valid`), in order.
CLEAN_COLUMNS = (
    "reading_id", "device_id", *MEASURE_COLUMNS, "processing_timestamp",
)

# Required input columns for the daily summary.
DAILY_REQUIRED = (
    "device_id", "date", "air_temperature", "wind_speed", "rain_gauge",
    "air_humidity", "barometric_pressure",
)
