"""The state store's answers: days to look at again and the readings before."""

import datetime as dt
import random

from pyspark.sql import functions as F

from meteoframe.session import scratch_path
from meteoframe.streaming import state
from tests.helpers import flat_df, reading


def _brute(batches):
    """Edges of every batch by looking at all readings so far."""
    seen, out = [], []
    for rows in batches:
        seen += rows
        ends = {}
        for device, at, rid, temp in seen:
            key = (device, at.date())
            if key not in ends or (at, ) > (ends[key][0], ) or (at == ends[key][0] and rid < ends[key][1]):
                ends[key] = (at, rid, temp)
        edges = set()
        for device in {r[0] for r in rows}:
            days = sorted(d for v, d in ends if v == device)
            new = {r[1].date() for r in rows if r[0] == device}
            for i, day in enumerate(days):
                if day in new or (i and days[i - 1] in new):
                    e = ends[device, days[i - 1]] if i else None
                    edges.add((device, str(day), *((str(days[i - 1]), e[0], e[2]) if e else (None, None, None))))
        out.append(edges)
    return out


def _stream(spark, batches):
    """Run the operator over the batches; (its rows per batch, rows per batch
    that the state store touched)."""
    src, got = scratch_path(spark, "state-src"), []
    schema = "device_id string, date string, processing_timestamp timestamp, reading_id string, air_temperature double"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    query, updated = None, []
    checkpoint = scratch_path(spark, "state-ck")
    for k, batch in enumerate(batches):
        made = spark.createDataFrame([(d, str(at.date()), at, rid, t) for d, at, rid, t in batch], schema)
        made.coalesce(1).write.mode("append").json(src)
    with state.stateful_session(spark):
        query = (state.day_ends(rows).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                 .foreachBatch(lambda df, k: got.append({tuple(r) for r in df.collect()}))
                 .trigger(availableNow=True).start())
    query.awaitTermination()
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"]]
    return got, updated


def test_edges_of_batches_in_any_order(spark):
    rng = random.Random(6)
    start = dt.datetime(2024, 1, 25)
    rows = [(rng.choice(["a", "b", None, ""]), start + dt.timedelta(days=rng.choice([0, 1, 2, 7, 40, 400]),
                                                                   minutes=rng.randrange(6)), f"r{i}",
             rng.choice([None, 1.5 * i])) for i in range(60)]
    batches = [rows[:25], rows[25:40], sorted(rows[40:], key=lambda r: -r[1].timestamp()), rows[:5]]
    got, _ = _stream(spark, batches)
    want = _brute(batches)
    # files of one second may come in any order; all batches together end alike
    assert len(got) == len(want)
    final = {}
    for edges in got:
        final |= {(e[0], e[1]): e[2:] for e in edges}
    last = {}
    for edges in _brute([rows + rows[:5]]):
        last |= {(e[0], e[1]): e[2:] for e in edges}
    assert final == last


def test_work_of_a_batch_does_not_grow(spark):
    """Fifty batches, a day each: every one updates the same few entries."""
    start = dt.datetime(2024, 1, 1)
    batches = [[(d, start + dt.timedelta(days=k, hours=h), f"r{k}-{h}", 1.0) for d in "abc" for h in (1, 2)]
               for k in range(50)]
    got, updated = _stream(spark, batches)
    assert len(got) == 50 and max(map(len, got)) <= 6
    assert max(updated) <= 6          # a month's entry a device, and its list of months when one begins


def test_corrected_stream_keeps_no_table_of_all_days(spark):
    """The fan-out started as a stream asks the state store alone."""
    import os

    from meteoframe import params as P
    from meteoframe.sources import envelope
    from meteoframe.streaming import fanout, sources

    src = scratch_path(spark, "t-src")
    for k, hour in enumerate((5, 1)):                     # the later batch comes before the first
        rows = [reading(reading_id=f"r{k}{i}", device_id=f"d{i % 2}", air_temperature=10.0 + 4 * k + i,
                        processing_timestamp=dt.datetime(2024, 5, 3 - k, hour, i)) for i in range(4)]
        envelope.encode_envelope(flat_df(spark, rows)).select("value").coalesce(1).write.mode("append").text(src)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=P.CORRECTED)
    raw = sources.read_envelope_files(spark, src, max_files_per_trigger=1)
    fanout.start_pipeline(spark, raw, t, checkpoint=scratch_path(spark, "t-ck"), available_now=True).awaitTermination()
    assert not os.path.exists(t.path("day_ends"))
    rows = {r.reading_id: r for r in spark.read.parquet(t.path("qc")).collect()}
    assert len(rows) == 8
    assert rows["r00"].time_diff == 24 * 60 + 4 * 60 - 2 and rows["r00"].tair_step == 10.0 - 16.0
    assert rows["r10"].time_diff is None and rows["r12"].time_diff == 2.0
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != list(state.CONF.values())[0]


def test_a_task_passes_on_one_row_a_device_day():
    """What is shuffled to the state does not grow with the readings of a day; the
    row is the one that the state would take (latest, then least id)."""
    import pandas as pd

    rng = random.Random(3)
    rows = [(rng.choice(["da", "db", "n"]), rng.choice(["2024-01-01", "2024-01-02"]), rng.randrange(40),
             f"r{rng.randrange(30)}", rng.choice([None, 1.0, 2.0])) for _ in range(2000)]
    frames = [pd.DataFrame(rows[i:i + 20], columns=["device", "date", "micros", "reading_id", "air_temperature"])
              for i in range(0, len(rows), 20)]
    got = pd.concat(state._ends_of_task(iter(frames)))
    want = {}
    for device, date, micros, rid, _ in rows:
        want[device, date] = min(want.get((device, date), (1, "")), (-micros, rid))
    assert {(r.device, r.date): (-r.micros, r.reading_id) for r in got.itertuples()} == want
    assert len(got) == 6
