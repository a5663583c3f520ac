"""The batch table job equals the lazy chain it materialises."""

import pytest
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.plans import pipeline
from meteoframe.session import scratch_path
from meteoframe.sources.tables import load_readings
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("mode", P.MODES)
def test_write_tables_matches_lazy_chain(spark, mode):
    readings = load_readings(spark, SF_SMALL)
    paths = pipeline.write_tables(readings, scratch_path(spark, "t-batch"), mode=mode)
    got = {r.reading_id: r.asDict() for r in spark.read.parquet(paths["qc"]).collect()}
    want = {r.reading_id: r.asDict() for r in pipeline.qc_audit(readings, mode).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        g = got[k]
        for c, v in w.items():
            if c == "date":
                assert str(g[c]) == v
            elif isinstance(v, float):
                assert g[c] == pytest.approx(v, rel=1e-9, abs=1e-9), (k, c)
            else:
                assert g[c] == v, (k, c)
    daily = spark.read.parquet(paths["daily"]).count()
    assert daily == pipeline.daily(readings, mode).count()


@pytest.mark.parametrize("mode", P.MODES)
def test_empty_input_flows_through_every_operator(spark, mode):
    from tests.helpers import flat_df
    from meteoframe.operators import quality
    empty = flat_df(spark, [])
    out = pipeline.run_batch(empty, mode)
    for name in ("cleaned", "imputed", "scored", "daily", "qc"):
        assert getattr(out, name).count() == 0, name
    rep = {r.rule: r.passed for r in quality.quality_report(out.daily).collect()}
    assert rep["non_empty"] is False and rep["all"] is False


def test_all_invalid_batch_is_empty_after_cleaning(spark):
    from tests.helpers import flat_df, reading
    rows = [reading(reading_id=f"r{i}", valid=False) for i in range(5)]
    out = pipeline.run_batch(flat_df(spark, rows))
    assert out.scored.count() == 0 and out.qc.count() == 0


def test_write_tables_skips_daily_when_the_gate_fails(spark):
    from tests.helpers import flat_df, reading
    rows = [reading(reading_id=f"r{i}", air_temperature=None) for i in range(3)]
    paths = pipeline.write_tables(flat_df(spark, rows), scratch_path(spark, "t-gate"),
                                  mode=P.CORRECTED)
    assert "daily" not in paths and "clean" in paths and "qc" in paths


def test_rerun_replaces_the_whole_batch_job(spark):
    from tests.helpers import flat_df, reading
    import datetime as dt
    root = scratch_path(spark, "t-rerun")
    day = lambda i: dt.datetime(2024, 5, 1 + i)
    rows = [reading(reading_id=f"r{i}", processing_timestamp=day(i)) for i in range(6)]
    pipeline.write_tables(flat_df(spark, rows), root)
    paths = pipeline.write_tables(flat_df(spark, rows[:2]), root)
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == {"clean": 2, "daily": 2, "qc": 2}


@pytest.mark.parametrize("mode", P.MODES)
def test_batch_job_without_a_valid_row(spark, mode):
    from tests.helpers import flat_df, reading
    rows = [reading(reading_id=f"r{i}", valid=False) for i in range(3)]
    assert pipeline.write_tables(flat_df(spark, rows), scratch_path(spark, "t-none"), mode=mode) == {}


def test_write_batch_replaces_under_a_dynamic_session(spark):
    from meteoframe.sinks import writers
    key, path = "spark.sql.sources.partitionOverwriteMode", scratch_path(spark, "t-dynamic")
    was = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        for n in (4, 2):
            writers.write_batch(spark.range(n).withColumn("d", F.col("id")), path, 0, ["d"])
        assert spark.read.parquet(path).count() == 2
    finally:
        spark.conf.set(key, was)


def test_input_bytes_and_sizing(spark):
    from meteoframe.session import input_bytes, sizing
    path = scratch_path(spark, "t-size")
    spark.range(1000).write.mode("overwrite").parquet(path)
    import glob
    import os
    assert input_bytes(spark, path) == sum(map(os.path.getsize, glob.glob(path + "/*.parquet")))
    assert sizing(100 << 40)["spark.sql.shuffle.partitions"] == str((100 << 40) // (128 << 20))
