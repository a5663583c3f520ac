"""Composed plans: the per-batch chain clean -> impute -> score -> daily, and QC.

Each function returns lazy DataFrames; nothing runs until a sink or action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import params as P
from ..operators import aggregate, anomaly, clean, impute, qc, quality
from ..session import join_path
from ..sinks import writers


@dataclass
class BatchOutputs:
    """The tables one batch of flat readings produces."""
    cleaned: DataFrame     # validity filter, range nulls, date key
    imputed: DataFrame     # cleaned + mean fill
    scored: DataFrame      # imputed + anomaly score and flag ("clean" table)
    daily: DataFrame       # per device-day summary
    qc: DataFrame          # level-1 QC audit rows


def cleaned(readings: DataFrame) -> DataFrame:
    """Validity filter, range nulls and date key."""
    return clean.clean_readings(readings)


def imputed(readings: DataFrame, mode: str = P.AS_WRITTEN) -> DataFrame:
    """Cleaned readings with nulls filled by the column means."""
    return impute.impute_mean(cleaned(readings), mode=mode)


def scored(readings: DataFrame, mode: str = P.AS_WRITTEN) -> DataFrame:
    """Imputed readings with anomaly score and flag (one statistics pass)."""
    return anomaly.impute_and_score(cleaned(readings), mode=mode)


def daily(readings: DataFrame, mode: str = P.AS_WRITTEN) -> DataFrame:
    """Per device-day summary of the scored readings."""
    return aggregate.daily_summary(scored(readings, mode))


def qc_audit(readings: DataFrame, mode: str = P.AS_WRITTEN, thr=None) -> DataFrame:
    """QC over imputed readings (``as_written``) or over cleaned readings
    without imputation (``corrected``: a missing sensor must not pass)."""
    src = imputed(readings, mode) if mode == P.AS_WRITTEN else cleaned(readings)
    return qc.qc_level1(src, thr=thr, mode=mode)


def run_batch(readings: DataFrame, mode: str = P.AS_WRITTEN, thr=None) -> BatchOutputs:
    """Every table of one batch, as lazy DataFrames."""
    c = cleaned(readings)
    i = impute.impute_mean(c, mode=mode)
    s = anomaly.impute_and_score(c, mode=mode)
    d = aggregate.daily_summary(s)
    q = qc.qc_level1(i if mode == P.AS_WRITTEN else c, thr=thr, mode=mode)
    return BatchOutputs(c, i, s, d, q)


def write_tables(readings: DataFrame, root: str, mode: str = P.AS_WRITTEN, thr=None,
                 lag_buckets=P.LAG_BUCKET_SECONDS, stats_by: tuple = (),
                 quality_gate: bool = True, stats: DataFrame | None = None) -> dict:
    """Batch job over a whole readings table: writes `clean` (cleaned,
    imputed, scored; partitioned by date), then derives `daily` (written only
    when the quality gate passes) and `qc` from the written clean table.
    Returns the paths of the tables written. Tables that stood there are
    replaced as a whole; a table without rows is not written.

    The input is read twice (one statistics pass, none with ``stats``, and one
    row pass) and once more by the corrected QC, which looks at values before
    imputation. The daily summary and the other QC read the written clean table
    (columns pruned), so the lineage is cut at the first sink.
    """
    spark = readings.sparkSession
    paths = {n: join_path(root, n) for n in ("clean", "daily", "qc")}
    c = cleaned(readings)
    scored_rows = anomaly.impute_and_score(c, mode=mode, by=stats_by, stats=stats)
    seen = Observation()
    writers.write_partitions(scored_rows, paths["clean"], ["date"],
                             sort_by=["device_id", "processing_timestamp"], replace="all",
                             observe=(seen, [F.count(F.lit(1)).alias("rows")]))
    if not seen.get["rows"]:
        return {}
    # partition values come back as the text they were written as
    stored = spark.read.schema(scored_rows.schema).parquet(paths["clean"])
    daily_rows = aggregate.daily_summary(stored).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # the daily table is written only when the quality gate passes
        if not quality_gate or quality.gate_passed(quality.quality_report(daily_rows)):
            writers.write_partitions(daily_rows, paths["daily"], ["date"],
                                     sort_by=["device_id"], replace="all")
        else:
            paths.pop("daily")
    finally:
        daily_rows.unpersist()
    if mode == P.AS_WRITTEN:
        qc_src = stored.drop("anomaly_score", "is_anomaly")
    else:
        qc_src = c
    audit = qc.qc_level1(qc_src, thr=thr, mode=mode, bucket_seconds=lag_buckets)
    writers.write_partitions(audit, paths["qc"], ["date"],
                             sort_by=["device_id", "processing_timestamp"], replace="all")
    return paths
