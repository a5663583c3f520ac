"""Boundary tables: cleaning ranges and QC codes, below / at / above, null, NaN."""

import math

import pytest
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.functions import rules as R
from meteoframe.operators import clean, qc
from tests.helpers import flat_df, reading, rows_by, schema

NAN = float("nan")


def _one_col(spark, name, typ, values):
    return spark.createDataFrame([(f"r{i}", v) for i, v in enumerate(values)],
                                 schema(("reading_id", "s"), (name, typ)))


@pytest.mark.parametrize("col,typ,values,expect", [
    ("air_temperature", "d", [-50.1, -50.0, 60.0, 60.1, None, NAN],
     [None, -50.0, 60.0, None, None, None]),
    ("air_humidity", "i", [-1, 0, 100, 101, None], [None, 0, 100, None, None]),
    ("wind_speed", "d", [-0.1, 0.0, 5.0, None, NAN], [None, 0.0, 5.0, None, NAN]),
    ("uv_index", "d", [-1.0, 0.0, 15.0, 15.5, NAN], [None, 0.0, 15.0, None, None]),
    ("barometric_pressure", "i", [86999, 87000, 108000, 108001], [None, 87000, 108000, None]),
    ("rain_gauge", "d", [-1.0, 0.0, 3.0], [None, 0.0, 3.0]),
    ("rain_accumulation", "d", [-1.0, 0.0, NAN], [None, 0.0, NAN]),
    ("peak_wind_gust", "d", [-1.0, 0.0, NAN], [None, 0.0, NAN]),
    ("light_intensity", "i", [-1, 0, 5], [None, 0, 5]),
    ("wind_direction_sensor", "i", [-1, 0, 360, 361], [None, 0, 360, None]),
])
def test_null_outside_boundaries(spark, col, typ, values, expect):
    out = clean.null_outside(_one_col(spark, col, typ, values)).orderBy(
        F.expr("cast(substring(reading_id, 2) as int)"))
    got = [r[col] for r in out.collect()]
    for g, e in zip(got, expect):
        if isinstance(e, float) and math.isnan(e):
            assert g is not None and math.isnan(g)
        else:
            assert g == e


def test_clean_readings_filters_and_projects(spark):
    rows = [reading(reading_id="a", valid=True), reading(reading_id="b", valid=False),
            reading(reading_id="c", valid=None)]
    out = clean.clean_readings(flat_df(spark, rows))
    assert [r.reading_id for r in out.collect()] == ["a"]
    assert "valid" not in out.columns and out.columns[-1] == "date"
    assert out.first()["date"] == "2024-05-01"


def test_filter_valid_without_column_passes(spark):
    df = flat_df(spark, [reading()]).drop("valid")
    assert clean.filter_valid(df).count() == 1


def test_clip_negative(spark):
    df = _one_col(spark, "rain_gauge", "d", [-2.0, 0.0, 4.0, None])
    got = sorted(clean.clip_negative(df).collect(), key=lambda r: r.reading_id)
    assert [r.rain_gauge for r in got] == [0.0, 0.0, 4.0, None]


def _codes(spark, name, typ, values, expr):
    df = _one_col(spark, name, typ, values)
    out = df.select("reading_id", expr.alias("code"))
    m = {r.reading_id: r.code for r in out.collect()}
    return [m[f"r{i}"] for i in range(len(values))]


def test_temperature_codes_both_modes(spark):
    vals = [5.0, 10.0, 11.0, 25.0, 36.5, 45.0, 46.0, None]
    assert _codes(spark, "air_temperature", "d", vals, qc.BANDS["QC_Tair_range"].code()) == \
        [-2, 0, 0, 0, 0, 0, -2, 1]
    assert _codes(spark, "air_temperature", "d", vals, qc.BANDS["QC_Tair_range"].code(mode=P.CORRECTED)) == \
        [-2, 0, 0, 1, 0, 0, -2, 1]


def test_humidity_codes(spark):
    vals = [-1, 0, 19, 20, 100, 101, None]
    assert _codes(spark, "air_humidity", "i", vals, qc.BANDS["QC_RH_range"].code()) == [-2, 0, 0, 0, 0, -2, 1]
    assert _codes(spark, "air_humidity", "i", vals, qc.BANDS["QC_RH_range"].code(mode=P.CORRECTED)) == \
        [-2, 0, 0, 1, 1, -2, 1]


def test_wind_codes(spark):
    vals = [-0.1, 0.0, 0.29, 0.3, 20.0, 20.5, 40.0, 40.1, None]
    assert _codes(spark, "wind_speed", "d", vals, qc.BANDS["QC_WindSpeed_range"].code()) == \
        [-2, 0, 0, 0, 0, 0, 0, -2, 1]
    assert _codes(spark, "wind_speed", "d", vals, qc.BANDS["QC_WindSpeed_range"].code(mode=P.CORRECTED)) == \
        [-2, 1, 1, 1, 1, 0, 0, -2, 1]
    assert _codes(spark, "wind_speed", "d", vals, qc.winddir_requires_wind_code()) == \
        [0, 0, 0, 1, 1, 1, 1, 1, 1]


def test_direction_codes(spark):
    vals = [-1, 0, 360, 361, None]
    for mode in P.MODES:
        assert _codes(spark, "wind_direction_sensor", "i", vals,
                      qc.BANDS["QC_WindDir_range"].code(mode=mode)) == [-2, 1, 1, -2, 1]


def test_rain_increment_codes(spark):
    vals = [-0.5, 0.0, 20.0, 20.5, 40.0, 40.5, None]
    for mode in P.MODES:
        assert _codes(spark, "rain_gauge", "d", vals, qc.BANDS["QC_Rain_15min"].code(mode=mode)) == \
            [-2, 1, 1, 0, 0, -2, 1]


def test_step_codes(spark):
    vals = [-6.0, -5.0, -3.0, 0.0, 3.0, 3.5, 5.0, 5.5, None]
    assert _codes(spark, "tair_step", "d", vals, qc.BANDS["QC_Tair_step"].code()) == \
        [-2, 0, 0, 0, 0, 0, 0, -2, 1]
    assert _codes(spark, "tair_step", "d", vals, qc.BANDS["QC_Tair_step"].code(mode=P.CORRECTED)) == \
        [-2, 0, 1, 1, 1, 0, 0, -2, 1]


def test_daily_codes(spark):
    vals = [0.0, 150.0, 151.0, 300.0, 301.0, None]
    assert _codes(spark, "daily_rain_mm", "d", vals, qc.BANDS["QC_Rain_Daily"].code()) == [0, 0, 0, 0, -2, 1]
    assert _codes(spark, "daily_rain_mm", "d", vals, qc.BANDS["QC_Rain_Daily"].code(mode=P.CORRECTED)) == \
        [1, 1, 0, 0, -2, 1]
    frac = [0.79, 0.8, 1.0, None]
    assert _codes(spark, "daily_valid_frac", "d", frac, qc.daily_availability_code()) == [0, 1, 1, 0]


def test_time_gap_codes(spark):
    vals = [13.9, 14.0, 15.0, 16.0, 16.1, None]
    assert _codes(spark, "time_diff", "d", vals, qc.time_gap_code()) == [-1, 0, 0, 0, -1, 0]


def test_name_lists_order_and_time_gap_modes(spark):
    cols = list(P.QC_COLUMNS)
    row = {c: 1 for c in cols}
    row.update({"QC_time_gap": -1, "QC_Tair_range": -2, "QC_Rain_15min": 0, "QC_Rain_Daily": -2,
                "QC_WindDir_requires_wind": 0})
    df = spark.createDataFrame([tuple(row[c] for c in cols)], ",".join(f"{c} int" for c in cols))
    a = qc.collect_qc_results(df).first()
    assert a.qc_failed_checks == ["QC_Tair_range", "QC_Rain_Daily"]
    assert a.qc_warning_checks == ["QC_WindDir_requires_wind", "QC_Rain_15min"]
    c = qc.collect_qc_results(df, mode=P.CORRECTED).first()
    assert c.qc_warning_checks == ["QC_time_gap", "QC_WindDir_requires_wind", "QC_Rain_15min"]
    df0 = df.withColumn("QC_time_gap", F.lit(0))
    assert qc.collect_qc_results(df0).first().qc_warning_checks[0] == "QC_time_gap"
    assert "QC_time_gap" not in qc.collect_qc_results(df0, mode=P.CORRECTED).first().qc_warning_checks


def test_pressure_conversion_and_check(spark):
    df = _one_col(spark, "barometric_pressure", "i", [101325, 100000, None])
    out = rows_by(qc.convert_pressure_hpa(df))
    assert out["r0"]["pressure_hpa"] == pytest.approx(1013.25)
    assert out["r2"]["pressure_hpa"] is None
    hpa = _one_col(spark, "barometric_pressure", "i", [1000, 990])
    assert rows_by(qc.convert_pressure_hpa(hpa))["r0"]["pressure_hpa"] == 1000.0
    empty = _one_col(spark, "barometric_pressure", "i", [None])
    assert qc.convert_pressure_hpa(empty).first()["pressure_hpa"] is None
    chk = qc.add_checks(qc.expected_pressure(qc.convert_pressure_hpa(df)), "QC_Pressure_range")
    got = rows_by(chk)
    assert got["r0"]["QC_Pressure_range"] == -2        # 1013.25 hPa > 1010
    assert got["r1"]["QC_Pressure_range"] == 0         # 1000 hPa, deviation 13.25


def test_qc_code_rejects_unknown_mode():
    with pytest.raises(ValueError):
        R.qc_code(mode="other")
