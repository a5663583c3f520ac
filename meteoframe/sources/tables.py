"""Batch table sources: the driver parquet tables and the derived readings.

The test tables hold no sensor data, so readings are derived from `events`
by a fixed deterministic rule (FIXTURES.md §3). The derivation is plain
column arithmetic on the scan, so Catalyst prunes `events` to the five
columns it needs and the work grows with the table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_semantics


def table_path(sf_dir: str, name: str) -> str:
    """Path of a driver table: ``<sf_dir>/<name>.parquet``."""
    return os.path.join(sf_dir, f"{name}.parquet")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a DataFrame (lazy parquet scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


# Derivation of one reading per event row, as SQL expressions (each is sent
# to the JVM once, instead of one call per column operator).
_READING_EXPRS = (
    "concat('r', CAST(event_id AS STRING), sfx) AS reading_id",
    "concat('dev', CAST(user_id % 4 AS STRING)) AS device_id",
    "CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS BOOLEAN) WHEN event_id % 20 = 0 THEN false "
    "ELSE true END AS valid",
    "CASE WHEN event_id % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(event_id % 18 AS DOUBLE) END "
    "AS uv_index",
    "CASE WHEN event_id % 29 = 0 THEN CAST(-1 AS DOUBLE) WHEN event_id % 7 = 0 "
    "THEN CAST(event_id % 50 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rain_gauge",
    "CASE WHEN event_id % 31 = 0 THEN CAST(-2 AS DOUBLE) WHEN event_id % 501 = 1 "
    "THEN CAST(900 AS DOUBLE) ELSE CAST(event_id % 45 AS DOUBLE) END AS wind_speed",
    "CASE WHEN user_id % 4 = 3 THEN CAST(75 + event_id % 20 AS INT) "
    "ELSE CAST(event_id % 105 AS INT) END AS air_humidity",
    "CAST(value AS DOUBLE) AS peak_wind_gust",
    "CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(value / 4 + 8 AS DOUBLE) END "
    "AS air_temperature",
    "CAST(event_id % 1000 AS INT) AS light_intensity",
    "CAST(event_id % 100 AS DOUBLE) AS rain_accumulation",
    "CASE WHEN dayofmonth(ts) % 2 = 0 THEN CAST(101000 + event_id % 8000 AS INT) "
    "ELSE CAST(86500 + (event_id * 37) % 15000 AS INT) END AS barometric_pressure",
    "CAST(event_id % 380 AS INT) AS wind_direction_sensor",
    "CAST(ts AS TIMESTAMP) AS processing_timestamp",
)


def readings_from_events(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Flat readings derived from `events` (one per event, plus a copy of
    every 49th event with a distinct id, to exercise de-duplication).
    ``keep_event_id`` appends the source `event_id`."""
    # One scan: every 49th event yields a second row (suffix "d") through a
    # generator instead of a second read of the table.
    src = events.selectExpr(
        "event_id", "ts", "user_id", "value",
        "explode(CASE WHEN event_id % 49 = 0 THEN array('', 'd') ELSE array('') END) AS sfx")
    return src.selectExpr(*_READING_EXPRS, *(["event_id"] if keep_event_id else []))


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat readings derived from ``events`` (session semantics pinned)."""
    apply_semantics(spark)
    return readings_from_events(load_table(spark, sf_dir, "events"))


# The same derivation as SQL text, for the DuckDB oracle (FIXTURES.md §3).
READINGS_SQL = """
SELECT concat('r', CAST(event_id AS VARCHAR(20)), sfx) AS reading_id,
 concat('dev', CAST(user_id % 4 AS VARCHAR(20))) AS device_id,
 CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 20 = 0 THEN FALSE ELSE TRUE END AS valid,
 CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 18 AS DOUBLE) END AS uv_index,
 CASE WHEN event_id % 29 = 0 THEN CAST(-1 AS DOUBLE) WHEN event_id % 7 = 0 THEN CAST(event_id % 50 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rain_gauge,
 CASE WHEN event_id % 31 = 0 THEN CAST(-2 AS DOUBLE) WHEN event_id % 501 = 1 THEN CAST(900 AS DOUBLE) ELSE CAST(event_id % 45 AS DOUBLE) END AS wind_speed,
 CASE WHEN user_id % 4 = 3 THEN CAST(75 + event_id % 20 AS INT) ELSE CAST(event_id % 105 AS INT) END AS air_humidity,
 CAST(value AS DOUBLE) AS peak_wind_gust,
 CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(value / 4 + 8 AS DOUBLE) END AS air_temperature,
 CAST(event_id % 1000 AS INT) AS light_intensity,
 CAST(event_id % 100 AS DOUBLE) AS rain_accumulation,
 CASE WHEN day(ts) % 2 = 0 THEN CAST(101000 + event_id % 8000 AS INT) ELSE CAST(86500 + (event_id * 37) % 15000 AS INT) END AS barometric_pressure,
 CAST(event_id % 380 AS INT) AS wind_direction_sensor,
 ts AS processing_timestamp
FROM (SELECT *, '' AS sfx FROM events UNION ALL SELECT *, 'd' AS sfx FROM events WHERE event_id % 49 = 0) AS e
"""
