"""Streaming pipeline: decode, then a fan-out of every micro-batch to tables.

Per micro-batch (``foreachBatch``) the callback writes, in order, each step
only after the one before succeeded and each table only when it has rows:

1. dead letters: rows without a reading id or a parsable event time, with
   their text (both modes);
2. raw rows as JSON text with the time they were received;
3. keys: (date, reading_id) of the batch's new readings. A reading is new if no
   *other* batch has stored its key, so re-sent readings are dropped for ever,
   distinct ones are kept however late they come, and a replayed batch, whose
   own keys do not count, does the same again. Only the folders of the dates
   that the batch touches are opened; no state grows in memory. With
   ``Targets.unique_ids`` a reading id counts once whatever its event time: the
   state store tells which ids are new (``state.new_ids``), no key is stored;
4. clean rows (cleaned, imputed, scored);
5. the daily summary (quality-gated), and on request the 15-minute slot counts,
   of every touched date. Both are merged from the batch's own partial aggregates
   and those that earlier batches left of these dates (a row per device and date,
   or slot): no reading of an earlier batch is read;
6. the level-1 QC audit. ``as_written`` looks at the batch alone, as the
   reference does. ``corrected`` recomputes whole device-days: those with new
   readings and the next one of the device, whose first reading has a new
   predecessor; other devices' audit rows of the same dates are carried over. The
   state store tells which device-days these are and the reading before each
   (``state.day_ends``), so the audit does not depend on how the stream was cut
   into batches, and a batch costs the same however long the stream has run. The
   pressure unit is decided by quantile sketches kept per date.

Dated tables are laid out ``date=D/batch_id=K`` (``compact`` merges a closed
date's files), derived ones ``date=D``. With a table of reference statistics
(``Targets.stats``) imputation and scores do not depend on the batches either;
without one each batch is its own reference, as in the reference pipeline.

Targets are pluggable: ``Targets`` are parquet tables under a shared root, a
replay replacing its first attempt. ``JdbcTargets`` append to database tables as
the reference does (at-least-once; keys and stored readings stay under the
root) and check every table's columns before the stream starts.

Errors propagate: the query stops and the batch replays from the checkpoint
on restart instead of being committed with rows lost.
"""

from __future__ import annotations

import logging
from collections import deque
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DoubleType, StringType, StructField, StructType,
                               TimestampType)

from .. import params as P
from ..operators import aggregate, anomaly, clean, partials, qc, quality, series
from ..schemas import CLEAN_COLUMNS, FLAT_READING
from ..session import checkpoint_dir, input_bytes, join_path, path_exists, stage_table
from ..sinks import writers
from . import state
from .sources import decode_stream

log = logging.getLogger("meteoframe.stream")

MEASURES = tuple(P.CLEAN_RANGES)
_PARTITIONS = [StructField("date", DateType()), StructField("batch_id", StringType())]
KEYS = StructType([StructField("reading_id", StringType()), *_PARTITIONS])
#: Cleaned readings before imputation, as stored.
READINGS = StructType([*(FLAT_READING[c] for c in CLEAN_COLUMNS), *_PARTITIONS])
SCORED = StructType([*READINGS.fields[:-2], StructField("anomaly_score", DoubleType()),
                     StructField("is_anomaly", BooleanType()), *_PARTITIONS])
#: The last reading of each device-day, kept where no state store is.
EDGES = StructType([StructField("device_id", StringType()), StructField("processing_timestamp", TimestampType()),
                    StructField("air_temperature", DoubleType()), StructField("date", DateType())])


# columns of a batch with the state store's answers
_EDGE, _NEW = "_edge", "_new_id"
_PAIR = ("device_id", "date")
#: A quantile sketch of the pressures of each date.
SKETCHES = StructType([StructField("sketch", BinaryType()), *_PARTITIONS])


#: Columns of the reading tables with Bloom filters, and distinct values expected
#: in a row group.
BLOOMS = {"device_id": 4096}


@dataclass
class Targets:
    """Output tables under one root folder (shared storage on a cluster)."""
    root: str
    mode: str = P.AS_WRITTEN
    thr: dict | None = None
    quality_gate: bool = True
    lag_buckets: int | tuple = P.LAG_BUCKET_SECONDS   # e.g. (60, 86400) for dense devices
    stats_by: tuple = ()               # e.g. ("device_id",): per-device imputation / z-scores
    stats: str | None = None           # path of a table from ``anomaly.reference_stats``
    slots: bool = False                # keep the 15-minute slot counts too
    unique_ids: bool = False           # a reading id sent again with another event time is re-sent too

    def path(self, name: str) -> str:
        return join_path(self.root, name)

    def statistics(self, spark: SparkSession) -> DataFrame | None:
        return spark.read.parquet(self.stats) if self.stats else None

    # -- the fan-out's own tables, parquet for every kind of target ----------

    def stored(self, spark: SparkSession, name: str, dates: list, schema: StructType) -> DataFrame:
        """Rows of these dates of a dated table; only their folders are opened."""
        return writers.read_dates(spark, self.path(name), dates, schema)

    def store(self, name: str, df: DataFrame, batch_id: int, **kw) -> None:
        writers.write_dated(df, self.path(name), batch_id, **kw)

    def parts(self, name: str, new: DataFrame, dates: list, batch_id: int) -> DataFrame:
        """Partial aggregates of these dates from every batch: ``new`` ones (in
        which the date comes last) are stored as the batch's own, replacing its
        first attempt's."""
        self.store(name, new, batch_id, sort_by=[new.columns[0]], clustering="partition")
        schema = StructType([*new.schema.fields[:-1], *_PARTITIONS])
        return self.stored(new.sparkSession, name, dates, schema).drop("batch_id")

    def daily_rows(self, dates: list, scored: DataFrame, batch_id: int) -> DataFrame:
        """Daily summary of the touched dates from merged partials."""
        new = partials.daily_partials(scored)
        new = new.select(*[c for c in new.columns if c != "date"], F.to_date("date").alias("date"))
        return partials.finish(partials.merge(self.parts("daily_parts", new, dates, batch_id)))

    def slot_rows(self, dates: list, scored: DataFrame, batch_id: int) -> DataFrame:
        """Slot counts of the touched dates, added up."""
        return partials.merge_slots(self.parts("slot_parts", dated_slots(scored), dates, batch_id))

    def of_device(self, spark: SparkSession, name: str, device: str, dates: list, schema: StructType) -> DataFrame:
        """One device's rows of these dates of a reading table. Only the dates'
        folders are opened; in them the order by device, row groups' statistics
        and Bloom filters leave the row groups that may hold the device."""
        return self.stored(spark, name, dates, schema).filter(F.col("device_id") == F.lit(device))

    # -- output tables --------------------------------------------------------

    def write_batch(self, name: str, df: DataFrame, batch_id: int) -> None:
        writers.write_batch(df, self.path(name), batch_id)

    def write_clean(self, scored: DataFrame, batch_id: int, observe) -> None:
        self.store("clean", scored, batch_id, sort_by=["device_id", "processing_timestamp"], observe=observe, blooms=BLOOMS)

    def write_daily(self, daily: DataFrame, batch_id: int) -> None:
        writers.write_partitions(daily, self.path("daily"), ["date"], ["device_id"], "partition")

    def write_slots(self, slots: DataFrame) -> None:
        writers.write_partitions(slots, self.path("slots"), ["date"], ["device_id"], "partition")

    def write_qc(self, audit: DataFrame, batch_id: int, fresh: DataFrame, observe) -> None:
        """``as_written``: the batch's rows. ``corrected``: whole dates, which
        replace what stood there."""
        order = ["device_id", "processing_timestamp"]
        if self.mode == P.AS_WRITTEN:
            self.store("qc", audit, batch_id, sort_by=order, observe=observe, blooms=BLOOMS)
        else:
            writers.write_partitions(audit, self.path("qc"), ["date"], order, "hash", observe, blooms=BLOOMS)


@dataclass
class JdbcTargets(Targets):
    """Tables in a database reached through JDBC; ``root`` still holds the
    fan-out's own tables (keys, readings, day ends) on shared storage.

    Writes append, as the reference pipeline does: at-least-once (a replayed
    batch appends again unless the tables' keys reject duplicates), the daily
    summary is appended per batch rather than upserted, and the QC table gets
    the audit rows of the batch's own readings. Parquet ``Targets`` give
    exactly-once tables and the upserts.
    """
    url: str = ""
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    tables: dict = field(default_factory=dict)   # logical name -> table name
    connections: int | None = 8         # concurrent writers per table

    DEFAULT_TABLES = {"raw": "readings_raw", "clean": "readings_clean", "daily": "daily_summary",
                      "qc": "qc_audit", "dead_letter": "readings_rejected", "slots": "slot_counts"}

    def table(self, name: str) -> str:
        return {**self.DEFAULT_TABLES, **self.tables}[name]

    def options(self, name: str) -> dict:
        return writers.jdbc_options(self.url, self.table(name), self.user, self.password,
                                    self.driver)

    def append(self, name: str, df: DataFrame, observe=None) -> None:
        out = writers.coerce_write_types(df)
        if observe is not None:
            out = out.observe(observe[0], *observe[1])
        writers.write_jdbc(out, self.options(name), mode="append", num_partitions=self.connections)

    def write_batch(self, name, df, batch_id) -> None:
        self.append(name, df)

    def write_clean(self, scored, batch_id, observe) -> None:
        self.append("clean", scored, observe)

    def daily_rows(self, dates, scored, batch_id) -> DataFrame:
        return aggregate.daily_summary(scored)

    def write_daily(self, daily, batch_id) -> None:
        self.append("daily", daily)

    def write_slots(self, slots) -> None:
        self.append("slots", slots)

    def write_qc(self, audit, batch_id, fresh, observe) -> None:
        if self.mode == P.CORRECTED:
            audit = audit.join(fresh.select("reading_id"), "reading_id", "left_semi")
        self.append("qc", audit, observe)

    def preflight(self, spark: SparkSession) -> dict:
        """Columns each target table lacks or holds with another kind of type,
        compared with the schemas the fan-out writes (zero-row probes of every
        target; no data read)."""
        expected = expected_schemas(spark, self)
        return writers.preflight(spark, {n: (self.options(n), sch) for n, sch in expected.items()})


def expected_schemas(spark: SparkSession, targets: Targets) -> dict:
    """Schemas of the rows the fan-out writes to each table, taken from the
    lazy plans built over an empty batch (analysis only, no job)."""
    empty = spark.createDataFrame([], FLAT_READING)
    cleaned = clean.clean_readings(empty)
    scored = anomaly.impute_and_score(cleaned, mode=targets.mode, by=targets.stats_by)
    src = scored.drop("anomaly_score", "is_anomaly") if targets.mode == P.AS_WRITTEN else cleaned
    rejected = split_dead_letters(empty.withColumn("_raw", F.lit("")))[1]
    tables = {"raw": raw_rows(empty), "dead_letter": rejected, "clean": scored,
              "daily": aggregate.daily_summary(scored),
              "qc": qc.qc_level1(src, thr=targets.thr, mode=targets.mode)}
    if targets.slots:
        tables["slots"] = dated_slots(scored)
    return {name: writers.coerce_write_types(df).schema for name, df in tables.items()}


def raw_rows(df: DataFrame) -> DataFrame:
    return writers.raw_json(df).withColumn("received_at", F.current_timestamp())


def dated_slots(rows: DataFrame) -> DataFrame:
    """15-minute slot counts with the date that a slot starts on."""
    return aggregate.slot_availability(rows).withColumn("date", F.to_date("slot_start"))


def _is_dead() -> Column:
    return F.col("reading_id").isNull() | F.col("processing_timestamp").isNull()


def split_dead_letters(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows could not be decoded (no reading id) or have
    envelope text but no event time."""
    good = flat.filter(~_is_dead()).drop("_raw")
    bad = flat.filter(_is_dead()).select(F.col("_raw").alias("value"),
                                       F.current_timestamp().alias("rejected_at"))
    return good, bad


class FanOut:
    """The ``foreachBatch`` callback. ``metrics`` keeps the row counts of the
    latest batches."""

    def __init__(self, targets: Targets, dedup: bool = True):
        self.t, self.dedup = targets, dedup
        P.check_mode(targets.mode)
        self.metrics: deque = deque(maxlen=100)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if "_raw" in batch_df.columns:
            # only dead letters need their text: it would be most of what is kept
            batch_df = batch_df.withColumn("_raw", F.when(_is_dead(), F.col("_raw")))
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                self.process(batch, batch_id)
        finally:
            batch.unpersist()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        t, spark = self.t, batch.sparkSession
        counts = {}
        edges = firsts = None
        if _EDGE in batch.columns:
            edges = batch.filter(F.col(_EDGE).isNotNull()).select(f"{_EDGE}.*")
            batch = batch.filter(F.col(_EDGE).isNull()).drop(_EDGE)
        if _NEW in batch.columns:
            firsts = batch.filter(F.col(_NEW).isNotNull()).select(F.col(_NEW).alias("reading_id"))
            batch = batch.filter(F.col(_NEW).isNull()).drop(_NEW)
        good = batch.drop("_raw")
        if "_raw" in batch.columns:
            good, bad = split_dead_letters(batch)
            counts["dead_letter"] = {"rows": bad.count()}
            if counts["dead_letter"]["rows"]:
                t.write_batch("dead_letter", bad, batch_id)
        fresh = self.new_readings(spark, good, batch_id, firsts).persist(StorageLevel.MEMORY_AND_DISK)
        cleaned = clean.clean_readings(fresh)      # a projection of kept rows, cheaper than a copy of them
        try:
            found = fresh.agg(F.count(F.lit(1)).alias("rows"),
                              F.count_if(F.col("valid") == F.lit(True)).alias("valid"),
                              F.sort_array(F.collect_set(F.to_date("processing_timestamp"))).alias("dates")).first()
            counts["raw"] = {"rows": found["rows"], "valid": found["valid"]}
            if found["rows"]:
                t.write_batch("raw", raw_rows(fresh), batch_id)
                if firsts is None:
                    self.store_keys(fresh, batch_id)
            if found["valid"]:
                self.derive(spark, cleaned, fresh, found["dates"], edges, batch_id, counts)
        finally:
            fresh.unpersist()
        self.metrics.append((batch_id, counts))
        log.info("batch %s: %s", batch_id, counts)

    def derive(self, spark, cleaned, fresh, dates: list, edges, batch_id: int, counts: dict) -> None:
        """Every table that comes from valid readings. ``dates`` holds the
        calendar days of the batch's event times."""
        t = self.t
        of_clean, of_qc = Observation(f"clean_{batch_id}"), Observation(f"qc_{batch_id}")
        # the statistics (a row, or one per key) are kept, the rows are scored where they are needed
        stats = t.statistics(spark) if t.stats else anomaly.reference_stats(cleaned, by=t.stats_by)
        stats = stats.persist()
        scored = anomaly.impute_and_score(cleaned, mode=t.mode, by=t.stats_by, stats=stats)
        try:
            t.write_clean(scored, batch_id, (of_clean, [
                F.count(F.lit(1)).alias("rows"), F.count_if(F.col("is_anomaly")).alias("anomalies"),
                *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in MEASURES]]))
            daily = t.daily_rows(dates, scored, batch_id).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if not t.quality_gate or quality.gate_passed(quality.quality_report(daily)):
                    t.write_daily(daily, batch_id)
            finally:
                daily.unpersist()
            if t.slots:
                t.write_slots(t.slot_rows(dates, scored, batch_id))
            if t.mode == P.AS_WRITTEN:
                audit = qc.qc_level1(scored.drop("anomaly_score", "is_anomaly"), thr=t.thr,
                                     mode=t.mode, bucket_seconds=t.lag_buckets)
            else:
                t.store("readings", cleaned, batch_id, sort_by=["device_id", "processing_timestamp"], blooms=BLOOMS)
                t.store("pressures", cleaned.groupBy("date").agg(
                    aggregate.quantile_sketch("barometric_pressure").alias("sketch")), batch_id, sort_by=["date"], clustering="partition")
                audit = self.day_audit(spark, dates, edges)
            t.write_qc(audit, batch_id, fresh, (of_qc, [
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.size("qc_failed_checks") > 0).alias("with_failures"),
                F.count_if(F.size("qc_warning_checks") > 0).alias("with_warnings")]))
        finally:
            stats.unpersist()
        counts.update(clean=of_clean.get, qc=of_qc.get)

    # ------------------------------------------------------------- new readings

    def new_readings(self, spark: SparkSession, good: DataFrame, batch_id: int,
                     firsts: DataFrame | None = None) -> DataFrame:
        """One row per (date, reading_id) that no other batch has stored, or with
        ``unique_ids`` per reading id that the state store has not met (``firsts``;
        for a fan-out that is called without it, that no other batch has stored on
        any date). Of a key's rows in the batch the least stays."""
        if not self.dedup:
            return good
        if self.t.unique_ids:
            once = series.dedup(good, ("reading_id",), ("processing_timestamp",))
            if firsts is not None:
                return once.join(firsts, "reading_id", "left_semi").select(good.columns)
            return once.join(self.other_keys(spark, batch_id), "reading_id", "left_anti").select(good.columns)
        keyed = good.withColumn("_date", F.to_date("processing_timestamp"))
        days = [r[0] for r in keyed.select("_date").distinct().collect()]      # calendar days
        known = (self.t.stored(spark, "keys", days, KEYS).filter(F.col("batch_id") != str(batch_id))
                 .select("reading_id", F.col("date").alias("_date")))
        once = series.dedup(keyed, ("reading_id", "_date"), ("processing_timestamp",))
        return once.join(known, ["reading_id", "_date"], "left_anti").select(good.columns)

    def other_keys(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Keys of all dates that other batches have stored."""
        path = self.t.path("keys")
        stored = spark.read.schema(KEYS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], KEYS)
        return stored.filter(F.col("batch_id") != str(batch_id))

    def store_keys(self, fresh: DataFrame, batch_id: int) -> None:
        if self.dedup:
            self.t.store("keys", fresh.select("reading_id", F.to_date("processing_timestamp").alias("date")),
                         batch_id, sort_by=["reading_id"], clustering="partition")

    # ---------------------------------------------------------- whole-day audit

    def day_audit(self, spark: SparkSession, dates: list, edges: DataFrame | None) -> DataFrame:
        """QC of the device-days that the batch changes, with the audit rows of
        the other devices on these dates."""
        t = self.t
        edges = edges if edges is not None else self.stored_edges(spark, dates)
        edges = edges.withColumns({c: F.to_date(c) for c in ("date", "earlier_date")}).persist()
        try:
            again = sorted(r[0] for r in edges.select("date").distinct().collect())      # calendar days
            rows = t.stored(spark, "readings", again, READINGS).drop("batch_id")
            sketches = t.stored(spark, "pressures", again, SKETCHES)
            touched = edges.select(*_PAIR).distinct()
            context = (_without(edges.filter("earlier_date IS NOT NULL").select(
                "device_id", F.col("earlier_date").alias("date"), F.col("earlier_timestamp").alias("processing_timestamp"),
                F.col("earlier_temperature").alias("air_temperature")), touched).distinct())
            as_text = {"date": F.date_format("date", P.DATE_FORMAT)}
            audit = qc.qc_level1(
                _within(rows, touched).withColumns(as_text), thr=t.thr, mode=t.mode, bucket_seconds=t.lag_buckets,
                context=context.withColumns(as_text),
                median=aggregate.median_of_sketches(sketches, "sketch", "barometric_pressure"))
            whole = StructType([*(f for f in audit.schema.fields if f.name != "date"), StructField("date", DateType())])
            kept = _without(writers.read_dates(spark, t.path("qc"), again, whole), touched)
            out = audit.unionByName(kept.withColumns(as_text))
            return out.filter(F.col("date").isin([d.isoformat() for d in again]))
        finally:
            edges.unpersist()

    def stored_edges(self, spark: SparkSession, dates: list) -> DataFrame:
        """What ``state.day_ends`` tells, from a table of all device-days' last
        readings: for a fan-out that is called without the stateful operator."""
        t = self.t
        last = F.max_by(F.struct("processing_timestamp", "air_temperature"), F.col("processing_timestamp"))
        rows = t.stored(spark, "readings", dates, READINGS).drop("batch_id")
        ends = (series.dedup(rows, ("device_id", "processing_timestamp"))
                .groupBy(*_PAIR).agg(last.alias("e")).select("device_id", "e.*", "date"))
        writers.write_partitions(ends, t.path("day_ends"), ["date"], ["device_id"], "partition")
        ends = spark.read.schema(EDGES).parquet(t.path("day_ends"))
        by_day = Window.partitionBy("device_id").orderBy("date")
        earlier = F.lag(F.struct("date", "processing_timestamp", "air_temperature")).over(by_day)
        around = ends.withColumns({"_before": F.lag("date").over(by_day), "_earlier": earlier})
        return (around.filter(F.col("date").isin(dates) | F.col("_before").isin(dates))
                .select(*_PAIR, F.col("_earlier.date").alias("earlier_date"),
                        F.col("_earlier.processing_timestamp").alias("earlier_timestamp"),
                        F.col("_earlier.air_temperature").alias("earlier_temperature")))


def _same_pair(df: DataFrame, pairs: DataFrame):
    return (df["device_id"].eqNullSafe(pairs["device_id"])) & (df["date"] == pairs["date"])


def _within(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of these device-days."""
    return df.join(pairs, _same_pair(df, pairs), "left_semi")


def _without(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of other device-days."""
    return df.join(pairs, _same_pair(df, pairs), "left_anti")


def _bytes(df: DataFrame) -> int:
    """Bytes of the files that a staged table is read from."""
    files = df.inputFiles()
    return input_bytes(df.sparkSession, files[0].rsplit("/", 1)[0]) if files else 0


#: Size of a compacted file.
FILE_BYTES = 128 << 20


def compact(spark: SparkSession, targets: Targets, name: str, date, schema: StructType) -> None:
    """Merge the files of one closed date of a dated table into one batch
    folder, named after its latest batch, in files of about ``FILE_BYTES``
    that follow each other in the table's order. Run it when no batch of that date is
    in flight; the merged rows are staged first, so a failure leaves the date
    as it was or to be compacted again."""
    rows = targets.stored(spark, name, [date], schema)
    top = rows.agg(F.max(F.col("batch_id").cast("long"))).first()[0]
    if top is None:
        return
    merged = stage_table(rows.drop("batch_id"), "compact")
    order = [c for c in ("device_id", "processing_timestamp") if c in merged.columns] or merged.columns[:1]
    files = max(1, -(-_bytes(merged) // FILE_BYTES))
    (merged.drop("date").withColumn("batch_id", F.lit(str(top)))
     .repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .options(**writers.bloom_options({c: n for c, n in BLOOMS.items() if c in order})).partitionBy("batch_id").parquet(f"{targets.path(name)}/date={date}"))


def slot_counts_stream(flat: DataFrame, minutes: int = 15, watermark: str = "1 hour",
                       ts_col: str = "processing_timestamp", key: str = "device_id") -> DataFrame:
    """Readings per device and tumbling event-time slot, as a stream.

    With a watermark and append output a slot is emitted once, when the
    watermark passes its end, and its state is dropped then. Readings up to
    the watermark delay late are always counted; a reading for a slot that
    was already emitted is dropped (Spark may still count a later reading
    whose slot is not yet evicted). State holds only the open slots, so it
    does not grow with the stream.
    """
    w = F.window(F.col(ts_col), f"{minutes} minutes")
    return (flat.filter(F.col("valid") == F.lit(True))
                .withWatermark(ts_col, watermark)
                .groupBy(F.col(key), w.alias("slot"))
                .agg(F.count(F.lit(1)).alias("n_readings"))
                .select(key, F.col("slot.start").alias("slot_start"),
                        F.col("slot.end").alias("slot_end"), "n_readings"))


def start_pipeline(spark: SparkSession, raw_stream: DataFrame, targets: Targets,
                   checkpoint: str | None = None, dedup: bool = True,
                   available_now: bool = False, processing_time: str | None = None,
                   preflight: bool = True):
    """Start the streaming query: decode and fan out. Returns the
    StreamingQuery. ``dedup=False`` keeps re-sent readings too.

    For database targets every table is checked first and a missing column
    stops the start (instead of failing, or silently losing, later writes).
    """
    if preflight and isinstance(targets, JdbcTargets):
        gaps = {n: cols for n, cols in targets.preflight(spark).items() if cols}
        if gaps:
            raise RuntimeError(f"target tables lack columns: {gaps}")
    # an unparsable event time is null here in both modes: the row becomes a
    # dead letter instead of stopping the query for ever
    flat = decode_stream(raw_stream, P.CORRECTED, keep_raw=True)
    # the same micro-batch twice: whole rows, and what its few columns change
    unique = dedup and targets.unique_ids
    by_day = targets.mode == P.CORRECTED and not unique
    if unique:
        # a re-sent reading must not move a day's end: with unique ids the ends come
        # from a table, written after the ids are known (``FanOut.stored_edges``)
        flat = flat.unionByName(state.new_ids(flat).select(F.col("reading_id").alias(_NEW)), allowMissingColumns=True)
    if by_day:
        edges = state.day_ends(clean.clean_readings(flat))
        flat = flat.unionByName(edges.select(F.struct(*edges.columns).alias(_EDGE)), allowMissingColumns=True)
    ckpt = checkpoint or join_path(checkpoint_dir(spark), "readings_pipeline")
    w = (flat.writeStream.foreachBatch(FanOut(targets, dedup))
         .option("checkpointLocation", ckpt)
         .outputMode("update" if by_day else "append"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    with state.stateful_session(spark):
        return w.start()
