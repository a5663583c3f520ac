from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

from meteoframe import schemas as S

FLAT = S.FLAT_READING


def reading(**kw):
    """A flat reading row with defaults (a plausible in-range reading)."""
    import datetime as dt
    base = dict(reading_id="r1", device_id="d1", valid=True, uv_index=3.0, rain_gauge=0.0,
                wind_speed=2.0, air_humidity=50, peak_wind_gust=3.0, air_temperature=20.0,
                light_intensity=100, rain_accumulation=0.0, barometric_pressure=100000,
                wind_direction_sensor=90, processing_timestamp=dt.datetime(2024, 5, 1, 0, 0, 0))
    base.update(kw)
    return tuple(base[f.name] for f in FLAT.fields)


def flat_df(spark, rows):
    return spark.createDataFrame(rows, FLAT)


def rows_by(df, key="reading_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def schema(*fields):
    t = {"s": StringType(), "d": DoubleType(), "i": IntegerType(), "b": BooleanType(),
         "t": TimestampType()}
    return StructType([StructField(n, t[k]) for n, k in fields])
