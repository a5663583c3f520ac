"""Series operators against brute force: plain device-wide windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.operators import qc, series
from tests.helpers import flat_df, reading


def _random_rows(n=400, seed=7, hot_share=0.4):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        dev = "hot" if rnd.random() < hot_share else rnd.choice(["d1", "d2", "d3", None])
        ts = None if rnd.random() < 0.02 else t0 + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400))
        temp = None if rnd.random() < 0.1 else round(rnd.uniform(5, 40), 2)
        rows.append(reading(reading_id=f"r{i:04d}", device_id=dev, processing_timestamp=ts,
                            air_temperature=temp, rain_gauge=float(rnd.randrange(-1, 50))))
    return rows


def _brute_lag(df):
    w = Window.partitionBy("device_id").orderBy("processing_timestamp")
    sec = F.col("processing_timestamp").cast("long")
    return df.select("reading_id",
                     ((sec - F.lag(sec).over(w)) / 60.0).alias("time_diff"),
                     (F.col("air_temperature") - F.lag("air_temperature").over(w)).alias("tair_step"))


def _as_map(df, cols):
    return {r.reading_id: tuple(r[c] for c in cols) for r in df.collect()}


@pytest.mark.parametrize("bucket", [60, 3600, 86400, 10 ** 9, (60, 3600), (1, 600, 86400)])
def test_bucketed_lag_equals_device_window(spark, bucket):
    df = series.parse_and_dedup(flat_df(spark, _random_rows()))
    want = _as_map(_brute_lag(df), ["time_diff", "tair_step"])
    got = series.time_diff(df, bucket_seconds=bucket)
    got = series.step(got, bucket_seconds=bucket)
    have = _as_map(got, ["time_diff", "tair_step"])
    # rows sorting first in a device (null time) are tie-ordered arbitrarily
    # by both sides only when a device has several null-time rows; dedup
    # leaves at most one, so everything must match exactly.
    assert have == want


def test_with_previous_group_totals_match_join(spark):
    df = series.parse_and_dedup(flat_df(spark, _random_rows(seed=3)))
    df = df.withColumn("date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    got = series.with_previous(df, ["air_temperature"], group=("date",),
                               counts={"n": "processing_timestamp"}, sums={"rain": "rain_gauge"},
                               bucket_seconds=(600, 7200))
    m = df.groupBy("device_id", "date").agg(F.count("processing_timestamp").alias("n"),
                                            F.sum("rain_gauge").alias("rain"))
    want = df.join(m, ["device_id", "date"], "left")
    assert _as_map(got, ["n", "rain"]) == _as_map(want, ["n", "rain"])


def test_dedup_keeps_lowest_reading_id_and_null_keys_merge(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [reading(reading_id="b", processing_timestamp=t, air_temperature=1.0),
            reading(reading_id="a", processing_timestamp=t, air_temperature=2.0),
            reading(reading_id=None, processing_timestamp=t, air_temperature=3.0),
            reading(reading_id="c", processing_timestamp=None),
            reading(reading_id="d", processing_timestamp=None),
            reading(reading_id="e", device_id=None, processing_timestamp=t),
            reading(reading_id="f", device_id=None, processing_timestamp=t)]
    out = series.parse_and_dedup(flat_df(spark, rows))
    ids = sorted(r.reading_id for r in out.collect())
    assert ids == ["a", "c", "e"]
    assert out.filter(F.col("reading_id") == "a").first().air_temperature == 2.0
    assert out.columns == flat_df(spark, rows).columns


def test_dedup_is_order_independent(spark):
    rows = _random_rows(seed=11)
    rows = rows + [r[:0] + ("x" + r[0],) + r[1:] for r in rows[:100]]
    a = series.parse_and_dedup(flat_df(spark, rows)).collect()
    b = series.parse_and_dedup(flat_df(spark, list(reversed(rows))).repartition(7)).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_qc_level1_partitioning_independent(spark):
    df = flat_df(spark, _random_rows(seed=5)).withColumn(
        "date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    a = qc.qc_level1(df).collect()
    b = qc.qc_level1(df.repartition(9), bucket_seconds=(600, 86400)).collect()
    key = lambda r: r.reading_id
    assert sorted(a, key=key) == sorted(b, key=key)


def test_qc_level1_staged_equals_unstaged(spark):
    df = flat_df(spark, _random_rows(seed=9)).withColumn(
        "date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    key = lambda r: r.reading_id
    assert sorted(qc.qc_level1(df).collect(), key=key) == \
        sorted(qc.qc_level1(df, stage=True).collect(), key=key)


def test_qc_level1_daily_metrics_null_for_null_keys(spark):
    rows = [reading(reading_id="a", device_id=None),
            reading(reading_id="b", processing_timestamp=None)]
    df = flat_df(spark, rows).withColumn("date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    out = {r.reading_id: r for r in qc.qc_level1(df).collect()}
    for k in ("a", "b"):
        assert out[k].daily_valid_frac is None and out[k].daily_rain_mm is None
        assert out[k].QC_Daily_Availability == 0 and out[k].QC_Rain_Daily == 1


def test_qc_level1_modes_differ_only_where_documented(spark):
    df = flat_df(spark, _random_rows(seed=13)).withColumn(
        "date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    a = {r.reading_id: r.asDict() for r in qc.qc_level1(df).collect()}
    b = {r.reading_id: r.asDict() for r in qc.qc_level1(df, mode=P.CORRECTED).collect()}
    same = ["time_diff", "tair_step", "daily_valid_frac", "daily_rain_mm", "QC_time_gap",
            "QC_WindDir_range", "QC_WindDir_requires_wind", "QC_Rain_15min",
            "QC_Daily_Availability", "qc_failed_checks"]
    for k in a:
        for c in same:
            assert a[k][c] == b[k][c], (k, c)


def test_qc_level1_twice_equals_once(spark):
    df = flat_df(spark, _random_rows(seed=21)).withColumn(
        "date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    once = qc.qc_level1(df)
    again = qc.qc_level1(once.select(*df.columns))
    key = lambda r: r.reading_id
    assert sorted(once.collect(), key=key) == sorted(again.collect(), key=key)


def test_qc_level1_row_order_independent(spark):
    rows = _random_rows(seed=17)
    a = flat_df(spark, rows).withColumn("date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    b = flat_df(spark, list(reversed(rows))).repartition(5).withColumn(
        "date", F.date_format("processing_timestamp", "yyyy-MM-dd"))
    key = lambda r: r.reading_id
    for mode in P.MODES:
        assert sorted(qc.qc_level1(a, mode=mode).collect(), key=key) == \
            sorted(qc.qc_level1(b, mode=mode).collect(), key=key)


def test_dedup_survivor_rule_against_python(spark):
    """Survivor per (device, time): lowest reading id, nulls last, then the
    smallest remaining columns -- checked against a plain-Python selection."""
    rnd = random.Random(99)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        rid = None if rnd.random() < 0.05 else f"r{rnd.randrange(0, 400):03d}"
        rows.append(reading(reading_id=rid, device_id=rnd.choice(["d1", "d2", None]),
                            processing_timestamp=t0 + dt.timedelta(minutes=rnd.randrange(0, 60)),
                            air_temperature=float(rnd.randrange(0, 5))))
    got = {(r.device_id, r.processing_timestamp): (r.reading_id, r.air_temperature)
           for r in series.parse_and_dedup(flat_df(spark, rows)).collect()}
    cols = [f.name for f in flat_df(spark, rows[:1]).schema.fields]
    i_id, i_dev, i_ts = cols.index("reading_id"), cols.index("device_id"), cols.index("processing_timestamp")
    rest = [k for k in range(len(cols)) if k not in (i_id, i_dev, i_ts)]

    def key(r):
        return (r[i_id] is None, r[i_id] or "", *[(r[k] is not None, r[k]) for k in rest])
    want = {}
    for r in rows:
        k = (r[i_dev], r[i_ts])
        if k not in want or key(r) < key(want[k]):
            want[k] = r
    assert got == {k: (r[i_id], r[cols.index("air_temperature")]) for k, r in want.items()}
