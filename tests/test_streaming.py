"""Structured Streaming fan-out: parity with batch, dead letters, replay,
restart, late and re-sent readings, whole-day recomputation."""

import datetime
import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meteoframe import params as P
from meteoframe.plans import pipeline
from meteoframe.session import scratch_path
from meteoframe.sources.tables import load_readings
from meteoframe.streaming import fanout, sources
from tests.conftest import SF_SMALL


def _files(spark, readings, n):
    src = scratch_path(spark, "t-src")
    sources.write_envelope_files(readings, src, n)
    sources.order_files_by_name(src)
    return src


def _run(spark, src, targets, ckpt=None, **kw):
    raw = sources.read_envelope_files(spark, src, max_files_per_trigger=1)
    q = fanout.start_pipeline(spark, raw, targets, checkpoint=ckpt or scratch_path(spark, "t-ck"),
                              available_now=True, **kw)
    q.awaitTermination()
    return q


def _daily_key_cols(df):
    return sorted((r.device_id, str(r.date), r.totalprecip_mm, r.daily_will_it_rain)
                  for r in df.select("device_id", "date", "totalprecip_mm",
                                     "daily_will_it_rain").collect())


def test_single_batch_equals_batch_pipeline(spark):
    readings = load_readings(spark, SF_SMALL)
    src = _files(spark, readings, 1)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    _run(spark, src, t)
    got = spark.read.parquet(t.path("daily"))
    # the wire carries milliseconds; the summary is otherwise the batch one
    want = pipeline.daily(readings.withColumn(
        "processing_timestamp", F.date_trunc("millisecond", "processing_timestamp")))
    assert _daily_key_cols(got) == _daily_key_cols(want)
    g = {(r.device_id, str(r.date)): r for r in got.collect()}
    for w in want.collect():
        r = g[(w.device_id, str(w.date))]
        assert abs(r.avgtemp_c - w.avgtemp_c) < 1e-9 and r.is_anomaly == w.is_anomaly
    assert spark.read.parquet(t.path("raw")).count() == readings.count()
    assert spark.read.parquet(t.path("qc")).count() == pipeline.qc_audit(readings).count()


def test_batches_upsert_daily_and_replay_is_idempotent(spark):
    readings = load_readings(spark, SF_SMALL)
    src = _files(spark, readings, 3)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    _run(spark, src, t)
    daily = spark.read.parquet(t.path("daily"))
    want = pipeline.daily(readings)
    assert daily.count() == want.count()
    assert _daily_key_cols(daily) == _daily_key_cols(want)
    n_clean = spark.read.parquet(t.path("clean")).count()
    # replay batch 1 by hand: the same partitions are overwritten, not appended
    raw = sources.decode_stream(spark.read.text(src))
    batch1 = raw.join(spark.read.parquet(t.path("raw")).filter("batch_id = 1")
                      .select(F.get_json_object("data", "$.reading_id").alias("reading_id")),
                      "reading_id", "left_semi")
    fanout.FanOut(t)(batch1, 1)
    assert spark.read.parquet(t.path("clean")).count() == n_clean
    assert _daily_key_cols(spark.read.parquet(t.path("daily"))) == _daily_key_cols(want)


def test_restart_from_checkpoint_processes_only_new_files(spark):
    readings = load_readings(spark, SF_SMALL)
    src = _files(spark, readings, 2)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    ck = scratch_path(spark, "t-ck")
    _run(spark, src, t, ckpt=ck)
    n_raw = spark.read.parquet(t.path("raw")).count()
    _run(spark, src, t, ckpt=ck)
    assert spark.read.parquet(t.path("raw")).count() == n_raw


def test_resent_readings_dropped_across_batches(spark):
    readings = load_readings(spark, SF_SMALL)
    src = _files(spark, readings, 2)
    # a third file re-sends the first 100 readings (the poller refetches)
    again = os.path.join(src, "part-99999-resend.txt")
    first = sorted(f for f in os.listdir(src) if f.startswith("part-"))[0]
    with open(os.path.join(src, first)) as fh, open(again, "w") as out:
        for i, line in enumerate(fh):
            if i < 100:
                out.write(line)
    sources.order_files_by_name(src)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    _run(spark, src, t)
    assert spark.read.parquet(t.path("raw")).count() == readings.count()


def test_dead_letters_in_corrected_mode(spark):
    src = scratch_path(spark, "t-src")
    good = {"message": "m", "success": True, "data": {
        "reading_id": "r1", "device_id": "d1", "created_at": "2024-05-01T00:00:00.000Z",
        "reading": {"valid": True, "air_temperature": 20.0, "air_humidity": 50, "uv_index": 1,
                    "rain_gauge": 0, "wind_speed": 1, "peak_wind_gust": 1.0, "light_intensity": 1,
                    "rain_accumulation": 0.0, "barometric_pressure": 100000,
                    "wind_direction_sensor": 10}}}
    bad_ts = json.loads(json.dumps(good))
    bad_ts["data"]["reading_id"] = "r2"
    bad_ts["data"]["created_at"] = "2024-05-01 00:00:00"
    with open(os.path.join(src, "part-00000.txt"), "w") as fh:
        fh.write(json.dumps(good) + "\n" + json.dumps(bad_ts) + "\n" + "not json\n")
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=P.CORRECTED)
    _run(spark, src, t)
    dead = spark.read.parquet(t.path("dead_letter")).collect()
    assert len(dead) == 2 and {d.value for d in dead} == {json.dumps(bad_ts), "not json"}
    assert spark.read.parquet(t.path("raw")).count() == 1
    assert spark.read.parquet(t.path("daily")).count() == 1


def _envelope(i, **reading):
    base = {"valid": True, "air_temperature": 20.0, "air_humidity": 50, "uv_index": 1, "rain_gauge": 0,
            "wind_speed": 1, "peak_wind_gust": 1.0, "light_intensity": 1, "rain_accumulation": 0.0,
            "barometric_pressure": 100000, "wind_direction_sensor": 10}
    return {"data": {"reading_id": f"r{i}", "device_id": "d1", "created_at": f"2024-05-01T00:{i:02d}:00.000Z",
                     "reading": {**base, **reading}}}


def _drop_in(src, name, lines):
    with open(os.path.join(src, name), "w") as fh:
        fh.write("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))
    sources.order_files_by_name(src)


@pytest.mark.parametrize("mode", P.MODES)
def test_bad_batches_do_not_stop_the_query(spark, mode):
    """Malformed, then invalid only, then good, then invalid only, over restarts."""
    bad_time = _envelope(1)
    bad_time["data"]["created_at"] = "bad"
    batches = [["not json", bad_time], [_envelope(i, valid=False) for i in (2, 3)],
               [_envelope(4), _envelope(5, air_temperature=21.0)], [_envelope(6, valid=False)], ["{}"]]
    src, ck = scratch_path(spark, "t-src"), scratch_path(spark, "t-ck")
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=mode)
    for i, lines in enumerate(batches):
        _drop_in(src, f"part-{i:05d}.txt", lines)
        _run(spark, src, t, ckpt=ck)
    assert spark.read.parquet(t.path("dead_letter")).count() == 3
    assert spark.read.parquet(t.path("raw")).count() == 5
    assert spark.read.parquet(t.path("clean")).count() == 2
    assert spark.read.parquet(t.path("qc")).count() == 2
    assert [r.maxtemp_c for r in spark.read.parquet(t.path("daily")).collect()] == [21.0]


def test_distinct_readings_are_kept_however_late(spark):
    """Newest first, each file sent twice, default settings."""
    src = scratch_path(spark, "t-src")
    for i in range(2):
        rows = []
        for k in range(15):
            e = _envelope(i * 15 + k)
            e["data"]["created_at"] = f"2024-{12 - 6 * i:02d}-{20 - k // 5:02d}T00:{k:02d}:00.000Z"
            rows.append(e)
        _drop_in(src, f"part-{i:05d}.txt", rows)
        _drop_in(src, f"part-{i:05d}-again.txt", rows)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    _run(spark, src, t)
    raw = spark.read.parquet(t.path("raw"))
    assert raw.count() == 30 and raw.select(F.get_json_object("data", "$.reading_id")).distinct().count() == 30
    assert "received_at" in raw.columns
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    _run(spark, src, t, dedup=False)
    assert spark.read.parquet(t.path("raw")).count() == 60


def test_only_touched_dates_are_opened_and_compaction(spark):
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    f = fanout.FanOut(t)
    src = scratch_path(spark, "t-src")
    for i in range(8):
        e = [_envelope(10 * i + k) for k in range(2)]
        for x in e:
            x["data"]["created_at"] = f"2024-05-{1 + i // 4:02d}T{i:02d}:00:00.{int(x['data']['reading_id'][1:]):03d}Z"
        _drop_in(src, f"part-{i:05d}.txt", e)
        f(sources.decode_stream(spark.read.text(os.path.join(src, f"part-{i:05d}.txt")), P.CORRECTED), i)
    days = [datetime.date(2024, 5, 1)]
    rows = t.stored(spark, "clean", days, fanout.SCORED)
    files = rows.inputFiles()
    assert len(files) == 4 and all("date=2024-05-01" in x for x in files)
    assert t.stored(spark, "clean", [datetime.date(1999, 1, 1)], fanout.SCORED).count() == 0
    before = sorted(map(str, rows.drop("batch_id").collect()))
    fanout.compact(spark, t, "clean", days[0], fanout.SCORED)
    after = t.stored(spark, "clean", days, fanout.SCORED)
    assert len(after.inputFiles()) == 1 and sorted(map(str, after.drop("batch_id").collect())) == before
    assert spark.read.parquet(t.path("clean")).count() == 16


def test_kafka_options_builder():
    o = sources.kafka_options("b:9092", "topic", max_offsets_per_trigger=1000)
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "topic",
                 "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000"}


def _audit(df):
    cols = [c for c in df.columns if c not in ("date", "batch_id")]
    return sorted(str([r[c] for c in cols]) for r in df.select(cols).collect())


@pytest.mark.parametrize("order, buckets", [("hour(processing_timestamp)", P.LAG_BUCKET_SECONDS),
                                            ("-unix_micros(processing_timestamp)", (600, 86400))])
def test_corrected_audit_does_not_depend_on_the_batches(spark, order, buckets):
    readings = load_readings(spark, SF_SMALL).filter("day(processing_timestamp) < 6").withColumn(
        "processing_timestamp", F.date_trunc("millisecond", F.col("processing_timestamp").cast("timestamp")))
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=P.CORRECTED, lag_buckets=buckets)
    f = fanout.FanOut(t)
    dealt = readings.withColumn("_o", F.ntile(3).over(Window.orderBy(F.expr(order), "reading_id")))
    for i in range(3):
        f(dealt.filter(F.col("_o") == i + 1).drop("_o"), i)
    got = spark.read.parquet(t.path("qc"))
    want = pipeline.qc_audit(readings, P.CORRECTED)
    assert _audit(got.select(want.columns)) == _audit(want)
    f(dealt.filter("_o = 3").drop("_o"), 2)                            # replay of the last batch
    assert _audit(spark.read.parquet(t.path("qc")).select(want.columns)) == _audit(want)


def test_reference_statistics_make_scores_independent_of_batches(spark):
    from meteoframe.operators import anomaly
    readings = load_readings(spark, SF_SMALL).filter("day(processing_timestamp) < 5")
    path = scratch_path(spark, "t-stats")
    anomaly.reference_stats(pipeline.cleaned(readings)).write.mode("overwrite").parquet(path)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=P.CORRECTED, stats=path)
    f = fanout.FanOut(t)
    for i in range(2):
        f(readings.filter(F.pmod(F.hash("reading_id"), F.lit(2)) == i), i)
    got = {r.reading_id: (r.anomaly_score, r.air_temperature) for r in spark.read.parquet(t.path("clean")).collect()}
    want = {r.reading_id: (r.anomaly_score, r.air_temperature) for r in pipeline.scored(readings, P.CORRECTED).collect()}
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-9 for k in want for a, b in zip(got[k], want[k]))


def test_empty_batch_is_skipped(spark):
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    empty = spark.createDataFrame([], "value string")
    fanout.FanOut(t)(sources.decode_stream(empty), 0)
    assert not os.path.exists(t.path("raw"))


def test_fanout_observed_metrics(spark):
    readings = load_readings(spark, SF_SMALL)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"))
    f = fanout.FanOut(t)
    src = _files(spark, readings, 1)
    f(sources.decode_stream(spark.read.text(src)), 0)
    (bid, m), = f.metrics
    assert m["raw"]["rows"] == readings.count()
    assert m["raw"]["valid"] == readings.filter("valid").count()
    assert m["clean"]["rows"] == m["raw"]["valid"]
    assert m["clean"]["anomalies"] == pipeline.scored(readings).filter("is_anomaly").count()
    assert m["qc"]["rows"] == spark.read.parquet(t.path("qc")).count()


def test_kafka_source_without_connector_explains(spark):
    import pytest
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        sources.read_kafka_stream(spark, sources.kafka_options("localhost:1", "t")).writeStream


def test_failed_quality_gate_skips_only_the_daily_write(spark):
    from tests.helpers import flat_df, reading
    rows = [reading(reading_id=f"r{i}", air_temperature=None) for i in range(3)]
    batch = flat_df(spark, rows)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=P.CORRECTED)
    fanout.FanOut(t)(batch, 0)
    assert spark.read.parquet(t.path("clean")).count() == 3
    assert spark.read.parquet(t.path("qc")).count() == 1      # one (device, time) after de-dup
    assert not os.path.exists(t.path("daily"))


def test_per_device_statistics_in_the_fanout(spark):
    from meteoframe.operators import anomaly
    readings = load_readings(spark, SF_SMALL)
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=P.CORRECTED,
                       stats_by=("device_id",))
    src = _files(spark, readings, 1)
    fanout.FanOut(t)(sources.decode_stream(spark.read.text(src)), 0)
    got = {r.reading_id: r.anomaly_score for r in spark.read.parquet(t.path("clean")).collect()}
    cleaned = pipeline.cleaned(readings.withColumn(
        "processing_timestamp", F.date_trunc("millisecond", "processing_timestamp")))
    want = {r.reading_id: r.anomaly_score for r in anomaly.impute_and_score(
        cleaned, mode=P.CORRECTED, by=("device_id",)).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_jdbc_targets_wiring(spark, monkeypatch):
    from meteoframe.sinks import writers
    written = []

    def fake_write_jdbc(df, options, mode="append", num_partitions=None):
        written.append((options["dbtable"], mode, dict(df.dtypes), df.count(), options))
    monkeypatch.setattr(writers, "write_jdbc", fake_write_jdbc)

    readings = load_readings(spark, SF_SMALL)
    src = _files(spark, readings, 1)
    for mode in P.MODES:
        written.clear()
        t = fanout.JdbcTargets(root=scratch_path(spark, "t-state"), mode=mode,
                               url="jdbc:postgresql://db:5432/x", user="u")
        fanout.FanOut(t)(sources.decode_stream(spark.read.text(src)), 0)
        tables = {w[0]: w for w in written}
        assert set(tables) >= {"readings_raw", "readings_clean", "daily_summary", "qc_audit"}
        assert all(w[1] == "append" for w in written)
        assert tables["readings_raw"][2] == {"data": "string", "received_at": "timestamp"}
        assert tables["readings_raw"][3] == readings.count()
        assert tables["readings_clean"][2]["date"] == "date"
        assert tables["readings_clean"][2]["processing_timestamp"] == "timestamp"
        assert tables["daily_summary"][2]["date"] == "date"
        assert tables["daily_summary"][3] == 120
        assert tables["qc_audit"][2]["qc_failed_checks"] == "array<string>"
        assert "password" not in tables["qc_audit"][4]
        if mode == P.CORRECTED:
            assert os.path.isdir(t.path("readings")) and os.path.isdir(t.path("day_ends"))


def test_jdbc_preflight_reports_missing_columns(spark, monkeypatch):
    from pyspark.sql.types import StringType, StructField, StructType, TimestampType
    from meteoframe.sinks import writers
    probed = []

    def fake_probe(spark_, options):
        probed.append(options["dbtable"])
        if options["dbtable"] == "daily_summary":        # a table without two columns
            exp = fanout.expected_schemas(spark_, t)["daily"]
            return StructType([f for f in exp.fields if f.name not in ("anomaly_score", "is_anomaly")])
        if options["dbtable"] == "readings_raw":
            return StructType([StructField("id", StringType()), StructField("data", StringType()),
                               StructField("received_at", TimestampType())])
        return {"readings_rejected": fanout.expected_schemas(spark_, t)["dead_letter"],
                "readings_clean": fanout.expected_schemas(spark_, t)["clean"],
                "qc_audit": fanout.expected_schemas(spark_, t)["qc"]}[options["dbtable"]]
    monkeypatch.setattr(writers, "probe_schema", fake_probe)
    t = fanout.JdbcTargets(root=scratch_path(spark, "t-state"), url="jdbc:postgresql://db/x")
    gaps = t.preflight(spark)
    assert sorted(probed) == ["daily_summary", "qc_audit", "readings_clean", "readings_raw", "readings_rejected"]
    assert gaps == {"raw": [], "dead_letter": [], "clean": [], "daily": ["anomaly_score", "is_anomaly"], "qc": []}
    import pytest
    raw = sources.read_envelope_files(spark, scratch_path(spark, "t-empty"))
    with pytest.raises(RuntimeError, match="anomaly_score"):
        fanout.start_pipeline(spark, raw, t, checkpoint=scratch_path(spark, "t-ck"))


def test_slot_stream_drops_late_readings(spark):
    import datetime as dt
    from tests.helpers import flat_df, reading
    from meteoframe.sources import envelope
    t0 = dt.datetime(2024, 5, 1, 0, 0)
    early = [reading(reading_id=f"a{i}", processing_timestamp=t0 + dt.timedelta(minutes=15 * i))
             for i in range(20)]                       # up to 04:45
    advance = [reading(reading_id="b", processing_timestamp=t0 + dt.timedelta(hours=8))]
    late = [reading(reading_id="late", processing_timestamp=t0 + dt.timedelta(minutes=5)),
            reading(reading_id="c", processing_timestamp=t0 + dt.timedelta(hours=8, minutes=5))]
    src = scratch_path(spark, "t-late")
    files = (early, advance, late)     # the 00:00 slot is emitted before the late reading comes
    for i, rows in enumerate(files):
        envelope.encode_envelope(flat_df(spark, rows)).select("value").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(src, f"f{i}"))
    # one directory per file, read in order
    for i in range(len(files)):
        for n in os.listdir(os.path.join(src, f"f{i}")):
            if n.startswith("part-"):
                os.rename(os.path.join(src, f"f{i}", n), os.path.join(src, f"part-{i:05d}.txt"))
    sources.order_files_by_name(src)
    out, ck = scratch_path(spark, "t-late-out"), scratch_path(spark, "t-late-ck")
    flat = sources.decode_stream(sources.read_envelope_files(spark, src), keep_raw=False)
    q = (fanout.slot_counts_stream(flat, watermark="1 hour").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.slot_start: r.n_readings for r in spark.read.parquet(out).collect()}
    assert got[t0] == 1                                # the late 00:05 reading was not counted
    assert len(got) == 20                              # every early slot closed; 08:00 still open


def _stamped(name, src, sent):
    """A file of envelopes, one for each (reading id number, event time)."""
    rows = []
    for i, at in sent:
        e = _envelope(i)
        e["data"]["created_at"] = at
        rows.append(e)
    _drop_in(src, name, rows)


def _first_sent(spark, t):
    return sorted((r.reading_id, str(r.processing_timestamp)) for r in spark.read.parquet(t.path("clean")).collect())


@pytest.mark.parametrize("mode", [P.AS_WRITTEN, P.CORRECTED])
def test_unique_ids_across_dates(spark, mode):
    """An id is kept as sent first, whatever date it is sent again with, before or
    after, in the same batch or a later one; a row that could not be read claims
    no id."""
    src = scratch_path(spark, "t-src")
    _stamped("part-00000.txt", src, [(1, "2024-05-03T00:00:00.000Z"), (1, "2024-05-02T00:00:00.000Z"), (2, "bad"),
                                     (3, "2024-05-03T00:10:00.000Z")])
    _stamped("part-00001.txt", src, [(1, "2024-04-01T00:00:00.000Z"), (2, "2024-05-04T00:00:00.000Z"),
                                     (3, "2024-05-03T00:10:00.000Z")])
    _stamped("part-00002.txt", src, [(3, "2024-06-01T00:00:00.000Z"), (2, "2023-01-01T00:00:00.000Z")])
    want = [(i, at) for i, at in zip(sorted(_envelope(k)["data"]["reading_id"] for k in (1, 2, 3)),
                                     ("2024-05-02 00:00:00", "2024-05-04 00:00:00", "2024-05-03 00:10:00"))]
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), mode=mode, unique_ids=True)
    _run(spark, src, t)
    assert _first_sent(spark, t) == want
    assert {str(r[0]) for r in spark.read.parquet(t.path("qc")).select("date").collect()} == {a[:10] for _, a in want}


def test_unique_ids_after_a_failed_batch(spark):
    """A batch that fails after its ids were asked for is run again with the same
    ids; the stream goes on after the restart as if nothing had happened."""
    src, ckpt = scratch_path(spark, "t-src"), scratch_path(spark, "t-ck")
    days = [f"2024-05-{d:02d}T00:00:00.000Z" for d in range(1, 5)]
    for k, day in enumerate(days):
        _stamped(f"part-{k:05d}.txt", src, [(i, day) for i in range(k, k + 4)])
    root = scratch_path(spark, "t-tables")

    class Failing(fanout.Targets):
        def write_clean(self, scored, batch_id, observe):
            if batch_id == 1:
                raise RuntimeError("lost")
            super().write_clean(scored, batch_id, observe)

    with pytest.raises(Exception, match="lost"):
        _run(spark, src, Failing(root=root, unique_ids=True), ckpt)
    t = fanout.Targets(root=root, unique_ids=True)
    query = _run(spark, src, t, ckpt)
    first = {_envelope(i)["data"]["reading_id"]: days[max(0, i - 3)] for i in range(len(days) + 3)}
    assert _first_sent(spark, t) == sorted((i, at[:10] + " 00:00:00") for i, at in first.items())
    # the store writes a batch's new ids only, and no table of keys is kept
    written = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    assert set(written) == {1}
    assert not os.path.exists(t.path("keys"))


def test_unique_ids_without_the_state_store(spark):
    """A fan-out called by itself asks the keys of all dates; a batch that runs
    again finds its own keys and does the same."""
    import datetime as dt
    from tests.helpers import flat_df, reading
    t = fanout.Targets(root=scratch_path(spark, "t-tables"), unique_ids=True)
    day = lambda d: dt.datetime(2024, 5, d)
    batches = [[("a", 2), ("b", 2)], [("a", 1), ("c", 3)], [("c", 9), ("b", 8), ("d", 1)]]
    for k in (0, 1, 1, 2, 2):
        fanout.FanOut(t)(flat_df(spark, [reading(reading_id=i, processing_timestamp=day(d)) for i, d in batches[k]]), k)
    assert _first_sent(spark, t) == [(i, str(day(d))) for i, d in (("a", 2), ("b", 2), ("c", 3), ("d", 1))]


def test_only_dead_letters_keep_their_text(spark, monkeypatch):
    """The text of a readable envelope is not kept with the batch."""
    lines = [json.dumps(_envelope(i)) for i in range(4)] + ["not json"]
    batch = sources.decode_stream(spark.createDataFrame([(x,) for x in lines], "value string"), P.CORRECTED)
    f, seen = fanout.FanOut(fanout.Targets(root=scratch_path(spark, "t-tables"))), []
    monkeypatch.setattr(f, "process", lambda kept, batch_id: seen.extend(r["_raw"] for r in kept.collect()))
    f(batch, 0)
    assert sorted(seen, key=str) == [None] * 4 + ["not json"]


def test_larger_tables_come_in_more_files(spark, monkeypatch):
    """A micro-batch's files keep their size; the micro-batches stay as many."""
    from meteoframe.streaming import queries
    assert queries._parts(spark, SF_SMALL) == 1
    monkeypatch.setattr(queries, "PART_BYTES", 2000)
    parts = queries._parts(spark, SF_SMALL)
    src = queries._envelope_files(spark, SF_SMALL, F.hour("processing_timestamp"))
    files = [n for n in os.listdir(src) if n.startswith("part-") and os.path.getsize(os.path.join(src, n))]
    assert parts > 1 and 4 * parts * 0.7 < len(files) <= 4 * parts
    assert spark.read.text(src).count() == load_readings(spark, SF_SMALL).count()
