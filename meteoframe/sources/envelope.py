"""JSON envelope codec: decode, flatten, explode API pages, encode.

Works on batch and streaming DataFrames alike (all built-in expressions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S


def parse_created_at(c, mode: str = P.AS_WRITTEN, fmt: str = P.CREATED_AT_FORMAT) -> Column:
    """Event-time text -> TIMESTAMP in the session zone.

    ``as_written`` raises on malformed text under ANSI; ``corrected`` yields
    null so the row can be routed to a dead-letter sink.
    """
    P.check_mode(mode)
    x = F.col(c) if isinstance(c, str) else c
    if mode == P.CORRECTED:
        return F.try_to_timestamp(x, F.lit(fmt))
    return F.to_timestamp(x, fmt)


def decode_envelope(df: DataFrame, value_col: str = "value", full: bool = False) -> DataFrame:
    """Decode JSON envelopes into the `data` fields (reading_id, device_id,
    reading struct, created_at). Bytes are cast to text first.

    By default the schema holds only `data`, so the parser skips `message`
    and `success`; ``full=True`` also returns those two.
    """
    v = F.col(value_col)
    if dict(df.dtypes).get(value_col) == "binary":
        v = v.cast("string")
    schema = S.ENVELOPE if full else S.ENVELOPE_DATA_ONLY
    parsed = df.select(F.from_json(v, schema).alias("_env"))
    cols = ["_env.data.*"]
    if full:
        cols = ["_env.message", "_env.success"] + cols
    return parsed.select(*cols)


def flatten_reading(df: DataFrame, mode: str = P.AS_WRITTEN, keep: tuple = ()) -> DataFrame:
    """Decoded `data` fields -> the 14-column flat reading (plus the
    ``keep`` columns, passed through first).

    The projection follows the declared schemas: a field of the flat reading
    comes from the envelope's `data` or its `reading` struct under the same
    name, cast where the two declare different types; `created_at` becomes
    `processing_timestamp`.
    """
    sensor = {f.name: f.dataType for f in S.READING_STRUCT.fields}

    def source(field) -> Column:
        if field.name in sensor:
            value = F.col(f"reading.{field.name}")
            return value if sensor[field.name] == field.dataType else value.cast(field.dataType)
        if field.name in S.DATA_STRUCT.names:
            return F.col(field.name)
        return parse_created_at("created_at", mode)

    return df.select(*keep, *[source(f).alias(f.name) for f in S.FLAT_READING.fields])


def decode_readings(df: DataFrame, value_col: str = "value", mode: str = P.AS_WRITTEN) -> DataFrame:
    """Envelope text/bytes -> flat readings (decode + flatten)."""
    return flatten_reading(decode_envelope(df, value_col), mode)


def _data_struct(prefix: str = "") -> Column:
    """`data` struct of the wire format, built from flat reading columns."""
    c = lambda n: F.col(prefix + n)
    reading = F.struct(
        c("valid").alias("valid"),
        c("uv_index").cast("int").alias("uv_index"),
        c("rain_gauge").cast("int").alias("rain_gauge"),
        c("wind_speed").cast("int").alias("wind_speed"),
        c("air_humidity").cast("int").alias("air_humidity"),
        c("peak_wind_gust").cast("double").alias("peak_wind_gust"),
        c("air_temperature").cast("double").alias("air_temperature"),
        c("light_intensity").cast("int").alias("light_intensity"),
        c("rain_accumulation").cast("double").alias("rain_accumulation"),
        c("barometric_pressure").cast("int").alias("barometric_pressure"),
        c("wind_direction_sensor").cast("int").alias("wind_direction_sensor"),
    )
    return F.struct(
        c("reading_id").alias("reading_id"),
        c("device_id").alias("device_id"),
        reading.alias("reading"),
        F.date_format(c("processing_timestamp"), P.CREATED_AT_FORMAT).alias("created_at"),
    )


def encode_envelope(df: DataFrame, message: str = "Request successful",
                    success: bool = True) -> DataFrame:
    """Flat readings -> one JSON envelope per reading (`key`, `value`).

    The key is the reading id, so a Kafka sink partitions a device's
    re-sent readings consistently.
    """
    env = F.struct(F.lit(message).alias("message"), F.lit(success).alias("success"),
                   _data_struct().alias("data"))
    return df.select(F.col("reading_id").alias("key"), F.to_json(env).alias("value"))


def encode_pages(df: DataFrame, page_col: str, message: str = "Request successful",
                 success: bool = True) -> DataFrame:
    """Flat readings -> API response pages: one envelope per `page_col`
    value whose `data` is the list of that page's readings.

    The caller must choose a page key with a bounded number of rows (an API
    page size); the list is assembled in one task per page.
    """
    pages = df.groupBy(page_col).agg(F.collect_list(_data_struct()).alias("_items"))
    env = F.struct(F.lit(message).alias("message"), F.lit(success).alias("success"),
                   F.col("_items").alias("data"))
    return pages.select(F.col(page_col).alias("page"), F.to_json(env).alias("value"))


def explode_pages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """API pages -> one envelope per reading (message and success repeated),
    as the `message`, `success`, `data` columns of the wire envelope."""
    parsed = df.select(F.from_json(F.col(value_col), S.ENVELOPE_PAGE).alias("_p"))
    return parsed.select(
        F.col("_p.message").alias("message"),
        F.col("_p.success").alias("success"),
        F.explode("_p.data").alias("data"),
    )
