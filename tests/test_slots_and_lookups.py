"""Empty slots, and device lookups that skip row groups."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meteoframe.operators import aggregate, clean
from meteoframe.session import scratch_path
from meteoframe.streaming import fanout
from tests.helpers import flat_df, reading

START = dt.datetime(1969, 12, 31, 22, 7)


def _brute(rows, minutes):
    width = dt.timedelta(minutes=minutes)
    epoch = dt.datetime(1970, 1, 1)
    cut = lambda at: epoch + (at - epoch) // width * width
    out = {}
    for device in {d for d, at in rows if at}:
        own = [cut(at) for d, at in rows if d == device and at]
        slot = min(own)
        while slot <= max(own):
            out[device, slot, slot + width] = own.count(slot)
            slot += width
    return out


@pytest.mark.parametrize("minutes", [15, 7, 1440])
def test_every_slot_between_first_and_last(spark, minutes):
    rnd = random.Random(minutes)
    rows = [(rnd.choice(["hot", "hot", "b", "", None]), START + dt.timedelta(minutes=rnd.randrange(6 * 1440), seconds=rnd.randrange(60)))
            for _ in range(60)] + [("one", START), ("one", START), ("none", None)]
    df = spark.createDataFrame(rows, "device_id string, processing_timestamp timestamp")
    counts = aggregate.slot_availability(df, minutes=minutes)
    got = aggregate.fill_slots(counts, minutes=minutes).collect()
    assert {(r.device_id, r.slot_start, r.slot_end): r.n_readings for r in got} == _brute(rows, minutes)
    assert len(got) == len(_brute(rows, minutes))
    # counts in parts are added up, and filled slots stay as they are
    twice = aggregate.fill_slots(counts.unionByName(counts), minutes=minutes)
    assert twice.agg(F.sum("n_readings")).first()[0] == 2 * 62
    assert sorted(map(str, aggregate.fill_slots(aggregate.fill_slots(counts, minutes=minutes), minutes=minutes).collect())) == sorted(map(str, got))


def test_slots_edges(spark):
    counts = aggregate.slot_availability(spark.createDataFrame([], "device_id string, processing_timestamp timestamp"))
    assert aggregate.fill_slots(counts).count() == 0
    with pytest.raises(ValueError):
        aggregate.fill_slots(counts, minutes=2000)


def test_device_lookup_opens_few_row_groups(spark, monkeypatch):
    """400 devices of one date from three batches, compacted into many files:
    a device's rows lie in one or two of their row groups."""
    t = fanout.Targets(scratch_path(spark, "t-lookup"))
    day = dt.date(2024, 5, 1)
    for batch in range(3):
        rows = [reading(reading_id=f"{batch}-{i}", device_id=f"dev{i * 37 % 400:03d}",
                        processing_timestamp=dt.datetime(2024, 5, 1) + dt.timedelta(seconds=i * 3 + batch)) for i in range(2000)]
        scored = (clean.clean_readings(flat_df(spark, rows)).withColumn("date", F.to_date("date"))
                  .withColumns({"anomaly_score": F.lit(0.0), "is_anomaly": F.lit(False)}))
        t.store("clean", scored, batch, sort_by=["device_id", "processing_timestamp"], blooms=fanout.BLOOMS)
    monkeypatch.setattr(fanout, "FILE_BYTES", 10_000)
    fanout.compact(spark, t, "clean", day, fanout.SCORED)
    files = [pq.ParquetFile(f) for f in glob.glob(f"{t.path('clean')}/date=2024-05-01/*/*.parquet")]
    groups = [f.metadata.row_group(g).column(f.schema_arrow.get_field_index("device_id")).statistics
              for f in files for g in range(f.metadata.num_row_groups)]
    assert len(groups) >= 10
    for device in ("dev000", "dev123", "dev399"):
        assert sum(s.min <= device <= s.max for s in groups) <= 2
        found = t.of_device(spark, "clean", device, [day], fanout.SCORED)
        assert found.count() == 15 and {r.device_id for r in found.collect()} == {device}
    assert t.of_device(spark, "clean", "dev123", [dt.date(2024, 5, 2)], fanout.SCORED).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(device_id,dev399)" in plan


def test_bloom_filter_skips_what_the_range_does_not(spark):
    """A value between a row group's least and greatest, in none of its rows and
    too many distinct ones for a dictionary: the group is not read."""
    from meteoframe.sinks import writers
    rows = spark.range(200_000).select(F.concat(F.lit("d"), F.lpad((F.col("id") * 2).cast("string"), 9, "0")).alias("device_id"),
                                       F.lit("2024-05-01").alias("date"))
    sizes = {}
    for name, blooms in (("with", {"device_id": 200_000}), ("without", None)):
        path = scratch_path(spark, "t-bloom")
        writers.write_partitions(rows.coalesce(1), path, ["date"], ["device_id"], "partition", blooms=blooms)
        got = spark.read.option("parquet.filter.columnindex.enabled", "false").parquet(path).filter("device_id = 'd000100001'")
        assert got.count() == 0
        sizes[name] = sum(f.stat().st_size for f in __import__("pathlib").Path(path).rglob("*.parquet"))
    assert sizes["with"] > sizes["without"] + 100_000          # the filter is there
