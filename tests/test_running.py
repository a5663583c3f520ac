"""Sliding reference statistics and stations as of a reading's time."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.operators import impute, qc, running
from tests.helpers import flat_df, reading


def test_sliding_statistics_against_the_readings(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), str(dt.date(2024, 2, 20) + dt.timedelta(days=rng.choice([0, 1, 2, 5, 6, 20]))),
             rng.choice([None, 1e9 + rng.random()]), k % 5) for k in range(300)] + [("c", "2024-02-20", float("nan"), 0),
                                                                               ("c", "2024-02-21", 1.0, 0)]
    df = spark.createDataFrame(rows, "device_id string, date string, x double, batch int")
    moments = running.merge_moments(running.day_moments(df, ["x"], ("device_id", "date", "batch")), ["x"])
    got = {(r.device_id, r.date): (r.mean_x, r.stddev_x) for r in running.sliding_stats(moments, 5, ["x"]).collect()}
    assert len(got) == len({r[:2] for r in rows})
    for (device, day), (mean, dev) in got.items():
        at = dt.date.fromisoformat(day)
        own = [x for d, when, x, _ in rows if d == device and x is not None
               and 1 <= (at - dt.date.fromisoformat(when)).days <= 5]
        if any(math.isnan(x) for x in own):
            assert math.isnan(mean) and math.isnan(dev)
            continue
        assert (mean is None) == (not own) and (dev is None) == (len(own) < 2)
        if own:
            assert math.isclose(mean, statistics.fmean(own), rel_tol=1e-12)
        if len(own) > 1:        # exact though the values differ in the tenth digit only
            assert math.isclose(dev, statistics.stdev(own), rel_tol=1e-6)


def test_void_column_parts_the_modes(spark):
    rows = [reading(reading_id=f"r{i}", light_intensity=None, uv_index=None if i else 2.0) for i in range(3)]
    df = flat_df(spark, rows)
    fixed = impute.impute_mean(df, mode=P.CORRECTED).collect()
    assert [(r.uv_index, r.light_intensity) for r in fixed] == [(2.0, None)] * 3
    with pytest.raises(Exception, match="light_intensity"):
        impute.impute_mean(df, mode=P.AS_WRITTEN).collect()


def test_stations_as_of_the_reading(spark):
    t = [dt.datetime(2024, 1, d) for d in range(1, 6)]
    rows = spark.createDataFrame([("a", t[0]), ("a", t[1]), ("a", t[2]), ("a", t[4]), ("b", t[4]), (None, t[4]),
                                  ("a", None), ("a", t[1])], "device_id string, processing_timestamp timestamp")
    stations = spark.createDataFrame([("a", t[1], 10.0), ("a", t[1], 20.0), ("a", t[3], None), (None, t[0], 5.0), ("c", t[0], 1.0),
                                      ("b", None, 7.0)], "device_id string, valid_from timestamp, altitude double")
    got = qc.with_station(rows, stations)
    assert got.columns == ["device_id", "processing_timestamp", "altitude"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.withColumn("altitude", F.when(
        (F.col("device_id") == "a") & F.col("processing_timestamp").isin(t[1], t[2]), 20.0)).collect()))
    assert qc.with_station(rows, stations.limit(0)).filter("altitude IS NOT NULL").isEmpty()
