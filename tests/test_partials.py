"""Mergeable aggregates: daily partials, quantile sketches, rank selection."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meteoframe.operators import aggregate, partials
from meteoframe.plans import pipeline
from meteoframe.sources.tables import load_readings
from tests.conftest import SF_SMALL
from tests.test_plans import final_plan


def _rows(df):
    def near(v):
        return repr(round(v, 9)) if isinstance(v, float) else v
    return sorted((tuple(near(v) for v in r) for r in df.collect()), key=str)


def test_partials_of_any_cut_merge_to_the_summary(spark):
    scored = pipeline.scored(load_readings(spark, SF_SMALL)).withColumn("date", F.to_date("date"))
    nan = scored.limit(3).withColumns({"device_id": F.lit("nan"), "air_temperature": F.lit(float("nan"))})
    none = scored.limit(3).withColumns({"device_id": F.lit(None).cast("string"), **{
        c: F.lit(None).cast(scored.schema[c].dataType) for c in
        ("air_temperature", "rain_gauge", "air_humidity", "barometric_pressure", "is_anomaly", "anomaly_score")}})
    scored = scored.unionByName(nan).unionByName(none)
    want = _rows(aggregate.daily_summary(scored))
    for cut in ("0", "pmod(xxhash64(reading_id), 3)", "hour(processing_timestamp) div 8"):
        parts = [partials.daily_partials(scored.filter(f"{cut} <=> {k}")) for k in range(1 if cut == "0" else 3)]
        both = parts[0]
        for more in parts[1:]:
            both = both.unionByName(more)
        assert _rows(partials.finish(partials.merge(partials.merge(both)))) == want


def test_slot_counts_add_up(spark):
    rows = pipeline.cleaned(load_readings(spark, SF_SMALL))
    halves = [aggregate.slot_availability(rows.filter(f"pmod(hash(reading_id), 2) = {k}")) for k in (0, 1)]
    assert _rows(partials.merge_slots(halves[0].unionByName(halves[1]))) == _rows(aggregate.slot_availability(rows))


@pytest.mark.parametrize("values", [
    [], [None, None], [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [7.0] * 999 + [1.0, 9.0], [float("nan")] * 3 + [1.0, 2.0],
    [float("-inf"), float("inf"), 0.0, None], [random.Random(3).gauss(0, 1e6) for _ in range(2001)],
    [float(random.Random(4).randrange(40)) for _ in range(500)]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got, want = aggregate.exact_median(df, "x").first()[0], df.agg(F.median("x")).first()[0]
    assert got == want or (got != got and want != want)


def test_exact_median_sends_no_values_to_one_task(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 10007).cast("double").alias("x"))
    out = aggregate.exact_median(df, "x", partitions=16)
    plan = final_plan(out)
    assert out.first()[0] == df.agg(F.median("x")).first()[0]
    # what meets in one task: the ranges' totals, and one partial row a task
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1:i + 4])
            assert "HashAggregate" in below or "part" in below, below
    assert "median(" not in plan


def test_sketches_of_many_batches(spark):
    df = spark.range(60000).select(F.pow(F.rand(1), 3).alias("x"), F.pmod("id", F.lit(50)).alias("b"))
    sketches = df.groupBy("b").agg(aggregate.quantile_sketch("x").alias("s"))
    m = aggregate.median_of_sketches(sketches, "s", "x").first()[0]
    assert abs(df.filter(F.col("x") < m).count() / 60000 - 0.5) < 0.01
    none = spark.createDataFrame([(None, 1), (float("nan"), 1)], "x double, b int")
    sketches = none.groupBy("b").agg(aggregate.quantile_sketch("x").alias("s"))
    assert aggregate.median_of_sketches(sketches, "s", "x").first()[0] is None
    assert aggregate.median_of_sketches(sketches.limit(0), "s", "x").first()[0] is None


def test_stream_reads_partials_not_clean_rows(spark, monkeypatch):
    """Daily rows of a batch: earlier batches' clean rows are not read."""
    from meteoframe.session import scratch_path
    from meteoframe.sinks import writers
    from meteoframe.streaming import fanout
    from tests.helpers import flat_df, reading

    read = []
    real = writers.read_dates
    monkeypatch.setattr(writers, "read_dates", lambda spark, path, dates, *a: (read.append(path.rsplit("/", 1)[1]),
                                                                              real(spark, path, dates, *a))[1])
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), slots=True)
    f = fanout.FanOut(t)
    for k in range(2):
        f(flat_df(spark, [reading(reading_id=f"r{k}{i}", air_temperature=10.0 * k + i, processing_timestamp=dt.datetime(
            2024, 5, 1, k, i)) for i in range(3)]), k)
    assert set(read) == {"keys", "daily_parts", "slot_parts"}
    (row,) = spark.read.parquet(t.path("daily")).collect()
    assert (row.maxtemp_c, row.mintemp_c, row.avgtemp_c) == (12.0, 0.0, 6.0)
    assert spark.read.parquet(t.path("slots")).agg(F.sum("n_readings")).first()[0] == 6
