"""Registered streaming queries: each writes the readings derived from the
driver tables as envelope files, runs a Structured Streaming query over them to completion (``availableNow``) and returns what its sink
wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..operators import aggregate, anomaly
from ..plans import oracle as O
from ..plans import pipeline
from ..plans.queries import DAILY_SQL, FLAT, QC_CORRECTED_SQL, SLOT_CALENDAR_SQL, qc_result, rounded_daily
from ..session import input_bytes, scratch_path
from ..sources import envelope
from ..sources.tables import load_readings, table_path
from . import fanout, sources

STREAM_QUERIES: dict = {}
STREAM_ORACLE: dict = {}

N_FILES = 4
#: Bytes of the events table that one task writes as envelopes.
PART_BYTES = 16 << 20


def _parts(spark, sf_dir) -> int:
    """Files that one micro-batch comes in: one for a small table, else as many
    as keep a file's size about the same however large the table is."""
    return max(1, -(-input_bytes(spark, table_path(sf_dir, "events")) // (N_FILES * PART_BYTES)))


def _envelope_files(spark, sf_dir, order_by=None) -> str:
    """The readings as envelope files, ``N_FILES`` times those of a micro-batch;
    ``order_by`` is a column that decides which file a reading is in (event time
    if None)."""
    src = scratch_path(spark, "stream-src")
    readings = load_readings(spark, sf_dir)
    files = N_FILES * _parts(spark, sf_dir)
    if order_by is None:
        sources.write_envelope_files(readings, src, files)
    else:
        # few distinct values (hours) are dealt over many files too
        more = [F.xxhash64("reading_id")] if files > N_FILES else []
        rows = readings.repartitionByRange(files, order_by, *more)
        envelope.encode_envelope(rows).select("value").write.mode("overwrite").text(src)
    return src


def _run(spark, sf_dir, src, one_batch=False, **targets) -> fanout.Targets:
    """The pipeline over the files at default settings, to completion. What it
    returns does not depend on the order in which files are read."""
    t = fanout.Targets(root=scratch_path(spark, "stream-tables"), **targets)
    raw = sources.read_envelope_files(spark, src, None if one_batch else _parts(spark, sf_dir))
    fanout.start_pipeline(spark, raw, t, checkpoint=scratch_path(spark, "stream-ckpt"),
                          available_now=True).awaitTermination()
    return t


def _statistics(spark, sf_dir) -> str:
    """Reference statistics of the whole readings table, stored. Event times
    are those on the wire (milliseconds)."""
    path = scratch_path(spark, "stream-stats")
    cleaned = pipeline.cleaned(load_readings(spark, sf_dir))
    anomaly.reference_stats(cleaned).write.mode("overwrite").parquet(path)
    return path


def stream_readings(spark, sf_dir):
    """File stream of envelopes -> decoded flat readings -> parquet sink."""
    src = _envelope_files(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    raw = sources.read_envelope_files(spark, src, max_files_per_trigger=1)
    flat = sources.decode_stream(raw, P.AS_WRITTEN, keep_raw=False)
    q = (flat.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


STREAM_QUERIES["src_stream_readings"] = stream_readings
STREAM_ORACLE["src_stream_readings"] = O.sql(["readings"], f"""
SELECT {FLAT}, date_trunc('millisecond', processing_timestamp) AS processing_timestamp
FROM readings""")



def _dates_as_text(df):
    return df.withColumn("date", F.col("date").cast("string"))


def stream_fanout(spark, sf_dir):
    """The daily table of one micro-batch over all readings, every column: the
    statistics of ``as_written`` are the batch's own."""
    t = _run(spark, sf_dir, _envelope_files(spark, sf_dir), one_batch=True)
    return rounded_daily(_dates_as_text(spark.read.parquet(t.path("daily"))))


def stream_newest_first(spark, sf_dir):
    """Readings sent newest first over several micro-batches: all are kept."""
    src = _envelope_files(spark, sf_dir, F.col("processing_timestamp").desc())
    t = _run(spark, sf_dir, src)
    return spark.read.parquet(t.path("raw")).select(
        F.get_json_object("data", "$.reading_id").alias("reading_id"))


def _sent_twice(spark, sf_dir) -> str:
    """The readings as envelope files and, in later files, every one of them again
    under the same id with its event time a day and an hour on."""
    src = _envelope_files(spark, sf_dir)
    at = F.col("processing_timestamp") + F.expr("INTERVAL 25 HOURS")
    rows = load_readings(spark, sf_dir).withColumn("processing_timestamp", at).repartitionByRange(
        N_FILES * _parts(spark, sf_dir), at)
    envelope.encode_envelope(rows).select("value").write.mode("append").text(src)
    return src


def stream_unique_ids(spark, sf_dir):
    """Readings sent again with another event date, over several micro-batches:
    of every id the one sent first is kept."""
    t = _run(spark, sf_dir, _sent_twice(spark, sf_dir), unique_ids=True)
    return _dates_as_text(spark.read.parquet(t.path("clean"))).select(
        "reading_id", "device_id", "processing_timestamp", "date")


def stream_daily_corrected(spark, sf_dir):
    """The corrected daily table, every column, from micro-batches cut by the
    hour of the day, with reference statistics."""
    t = _run(spark, sf_dir, _envelope_files(spark, sf_dir, F.hour("processing_timestamp")),
             mode=P.CORRECTED, stats=_statistics(spark, sf_dir))
    return rounded_daily(_dates_as_text(spark.read.parquet(t.path("daily"))))


def stream_qc_corrected(spark, sf_dir):
    """The corrected audit, every check, from micro-batches cut by the hour of
    the day: whole days are recomputed, so the cut does not show."""
    t = _run(spark, sf_dir, _envelope_files(spark, sf_dir, F.hour("processing_timestamp")), mode=P.CORRECTED)
    return qc_result(_dates_as_text(spark.read.parquet(t.path("qc"))))


def stream_qc_newest_first(spark, sf_dir):
    """The corrected audit from micro-batches that come newest first: every
    batch precedes what the state store remembers."""
    t = _run(spark, sf_dir, _envelope_files(spark, sf_dir, F.col("processing_timestamp").desc()), mode=P.CORRECTED)
    return qc_result(_dates_as_text(spark.read.parquet(t.path("qc"))))


def stream_slot_availability(spark, sf_dir):
    """Readings per device and 15-minute slot, kept up to date by date as
    micro-batches arrive in any order; every slot is there at the end."""
    t = _run(spark, sf_dir, _envelope_files(spark, sf_dir, F.hour("processing_timestamp")), slots=True)
    return spark.read.parquet(t.path("slots")).drop("date")


def stream_slot_calendar(spark, sf_dir):
    """The slots of the stream's table and the empty ones between them."""
    t = _run(spark, sf_dir, _envelope_files(spark, sf_dir, F.hour("processing_timestamp")), slots=True)
    return aggregate.fill_slots(spark.read.parquet(t.path("slots")))


SLOTS_SQL = O.on_wire(O.sql(["cleaned"], """
SELECT device_id, slot_start, slot_start + INTERVAL 15 minutes AS slot_end, count(*) AS n_readings
FROM (SELECT device_id, time_bucket(INTERVAL 15 minutes, processing_timestamp) AS slot_start
      FROM cleaned) AS s
GROUP BY device_id, slot_start"""))

STREAM_QUERIES.update(stream_fanout=stream_fanout, stream_newest_first=stream_newest_first,
                      stream_unique_ids=stream_unique_ids, stream_daily_corrected=stream_daily_corrected, stream_qc_corrected=stream_qc_corrected, stream_qc_newest_first=stream_qc_newest_first,
                      stream_slot_availability=stream_slot_availability, stream_slot_calendar=stream_slot_calendar)
STREAM_ORACLE.update(stream_fanout=O.on_wire(DAILY_SQL),
                     stream_newest_first=O.sql(["readings"], "SELECT reading_id FROM readings"),
                     stream_unique_ids=O.on_wire(O.sql(["cleaned"], """
SELECT reading_id, device_id, processing_timestamp, CAST(CAST(processing_timestamp AS DATE) AS VARCHAR) AS date
FROM cleaned""")),
                     stream_daily_corrected=O.on_wire(DAILY_SQL),
                     stream_qc_corrected=O.on_wire(QC_CORRECTED_SQL),
                     stream_qc_newest_first=O.on_wire(QC_CORRECTED_SQL),
                     stream_slot_availability=SLOTS_SQL,
                     stream_slot_calendar=O.on_wire(SLOT_CALENDAR_SQL))
