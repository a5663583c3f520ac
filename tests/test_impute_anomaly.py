"""Imputation, scoring and daily summary edge cases."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.operators import aggregate, anomaly, clean, impute, quality
from tests.helpers import flat_df, reading, rows_by

NAN = float("nan")


def cleaned(spark, rows):
    return clean.clean_readings(flat_df(spark, rows))


def test_int_mean_truncated_double_mean_exact(spark):
    rows = [reading(reading_id="a", air_humidity=1, air_temperature=1.0),
            reading(reading_id="b", air_humidity=2, air_temperature=2.0),
            reading(reading_id="c", air_humidity=2, air_temperature=2.0),
            reading(reading_id="d", air_humidity=None, air_temperature=None)]
    out = rows_by(impute.impute_mean(cleaned(spark, rows)))
    assert out["d"]["air_humidity"] == 1                 # mean 1.667 -> 1
    assert out["d"]["air_temperature"] == pytest.approx(5.0 / 3)


def test_nan_excluded_from_mean_and_kept(spark):
    rows = [reading(reading_id="a", wind_speed=NAN), reading(reading_id="b", wind_speed=4.0),
            reading(reading_id="c", wind_speed=None)]
    out = rows_by(impute.impute_mean(cleaned(spark, rows)))
    assert math.isnan(out["a"]["wind_speed"])
    assert out["c"]["wind_speed"] == 4.0


def test_all_null_everywhere_is_unchanged(spark):
    nulls = {c: None for c in P.IMPUTE_COLUMNS}
    rows = [reading(reading_id="a", **nulls), reading(reading_id="b", **nulls)]
    df = cleaned(spark, rows)
    assert impute.impute_mean(df).collect() == df.collect()


def test_one_column_without_values(spark):
    rows = [reading(reading_id="a", uv_index=None), reading(reading_id="b", uv_index=None)]
    df = cleaned(spark, rows)
    with pytest.raises(PySparkException, match="surrogate cannot be computed"):
        impute.impute_mean(df).collect()
    out = impute.impute_mean(df, mode=P.CORRECTED).collect()
    assert all(r.uv_index is None for r in out)
    with pytest.raises(PySparkException, match="surrogate"):
        anomaly.impute_and_score(df).collect()


def test_one_row_batch_scores_zero(spark):
    out = anomaly.zscore_score(cleaned(spark, [reading()])).first()
    assert out.anomaly_score == 0.0 and out.is_anomaly is False


def test_constant_feature_skipped_and_outlier_flagged(spark):
    # one outlier among n rows has |z| <= (n - 1) / sqrt(n): n = 201 allows > 10
    rows = [reading(reading_id=f"r{i}", air_temperature=20.0 + (i % 3), wind_speed=2.0)
            for i in range(200)]
    rows.append(reading(reading_id="hot", air_temperature=59.0, wind_speed=2.0))
    out = rows_by(anomaly.zscore_score(cleaned(spark, rows)))
    assert out["hot"]["is_anomaly"] is True
    assert out["r0"]["is_anomaly"] is False
    # wind_speed and the other constant features add nothing
    temps = [20.0 + (i % 3) for i in range(200)] + [59.0]
    m = sum(temps) / len(temps)
    sd = math.sqrt(sum((t - m) ** 2 for t in temps) / (len(temps) - 1))
    assert out["r1"]["anomaly_score"] == pytest.approx(abs(21.0 - m) / sd)


def test_nan_feature_is_skipped_not_propagated(spark):
    rows = [reading(reading_id="a", wind_speed=NAN, air_temperature=20.0),
            reading(reading_id="b", wind_speed=3.0, air_temperature=22.0)]
    out = rows_by(anomaly.zscore_score(cleaned(spark, rows)))
    assert not math.isnan(out["a"]["anomaly_score"])


def test_fused_equals_two_step(spark):
    rows = [reading(reading_id=f"r{i}", air_temperature=(None if i % 5 == 0 else 10.0 + i),
                    air_humidity=(None if i % 7 == 0 else 30 + i), wind_speed=float(i % 9),
                    uv_index=(None if i % 4 == 0 else float(i % 12)),
                    barometric_pressure=(None if i % 6 == 0 else 90000 + 100 * i))
            for i in range(60)]
    df = cleaned(spark, rows)
    a = rows_by(anomaly.zscore_score(impute.impute_mean(df)))
    b = rows_by(anomaly.impute_and_score(df))
    assert a.keys() == b.keys()
    for k in a:
        for c, v in a[k].items():
            if isinstance(v, float):
                assert b[k][c] == pytest.approx(v, rel=1e-9, abs=1e-12), (k, c)
            else:
                assert b[k][c] == v, (k, c)


def test_daily_summary_rules(spark):
    t0 = dt.datetime(2024, 5, 1, 1)
    rows = [reading(reading_id="a", air_humidity=70, barometric_pressure=99000, rain_gauge=None,
                    processing_timestamp=t0, wind_speed=10.0),
            reading(reading_id="b", air_humidity=71, barometric_pressure=99000, rain_gauge=None,
                    processing_timestamp=t0 + dt.timedelta(hours=1), wind_speed=5.0),
            reading(reading_id="c", air_humidity=69, barometric_pressure=99000, rain_gauge=None,
                    processing_timestamp=t0 + dt.timedelta(hours=2), wind_speed=1.0)]
    d = aggregate.daily_summary(cleaned(spark, rows)).first()
    assert d.totalprecip_mm is None and d.daily_will_it_rain == 0
    assert d.avghumidity == 70 and d.daily_chance_of_rain == 0       # avg 70.0 is not > 70
    assert d.maxwind_kph == pytest.approx(36.0)
    assert d.anomaly_score == 0.0 and d.is_anomaly is False            # defaults
    assert d.date_epoch == 1714521600
    assert d.processing_timestamp == t0 + dt.timedelta(hours=2)


def test_daily_summary_requires_columns(spark):
    df = cleaned(spark, [reading()]).drop("wind_speed")
    with pytest.raises(ValueError, match="wind_speed"):
        aggregate.daily_summary(df)


def test_daily_summary_creates_date_when_absent(spark):
    df = cleaned(spark, [reading()]).drop("date")
    d = aggregate.daily_summary(df).first()
    assert d.date == dt.date(2024, 5, 1)


def test_quality_report(spark):
    daily = aggregate.daily_summary(cleaned(spark, [reading()]))
    rep = {r.rule: r.passed for r in quality.quality_report(daily).collect()}
    assert rep["all"] is True
    assert quality.gate_passed(quality.quality_report(daily.limit(0))) is False
    nulls = daily.withColumn("mintemp_c", F.lit(None).cast("double"))
    assert quality.gate_passed(quality.quality_report(nulls)) is False
    bad_dev = daily.withColumn("device_id", F.lit(None).cast("string"))
    rep = {r.rule: r.passed for r in quality.quality_report(bad_dev).collect()}
    assert rep["device_id_not_null"] is False and rep["all"] is False


def test_null_profile_one_pass(spark):
    df = cleaned(spark, [reading(reading_id="a", uv_index=None), reading(reading_id="b", uv_index=99.0)])
    out = clean.null_profile(df, ["uv_index", "air_temperature"]).first()
    assert out.nulls_uv_index == 2 and out.nulls_air_temperature == 0


def test_supplied_statistics_tables(spark):
    rows = [reading(reading_id="a", device_id="d1", air_temperature=None),
            reading(reading_id="b", device_id="d2", air_temperature=None),
            reading(reading_id="c", device_id="d1", air_temperature=30.0)]
    df = cleaned(spark, rows)
    means = spark.createDataFrame([("d1", 11.0), ("d2", 22.0)], "device_id string, mean_air_temperature double")
    out = rows_by(impute.impute_mean(df, columns=["air_temperature"], stats=means, by=("device_id",)))
    assert out["a"]["air_temperature"] == 11.0 and out["b"]["air_temperature"] == 22.0
    assert out["c"]["air_temperature"] == 30.0
    stats = anomaly.feature_stats(df.fillna({"air_temperature": 20.0})).withColumn(
        "mean_air_temperature", F.lit(20.0)).withColumn("stddev_air_temperature", F.lit(2.0))
    scored = rows_by(anomaly.zscore_score(df.fillna({"air_temperature": 20.0}), stats=stats))
    assert scored["c"]["anomaly_score"] == pytest.approx(5.0)
