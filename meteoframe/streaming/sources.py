"""Stream sources and the envelope wire: Kafka (when its connector is on
the classpath) and a JSON-lines file stand-in with the same `value` column."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from .. import schemas as S
from ..sources import envelope


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = 1000,
                  extra: Mapping[str, str] | None = None) -> dict:
    """Options for the Kafka source. The starting offset applies to the
    first start only; afterwards the checkpoint decides."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def _need_kafka(exc: Exception) -> RuntimeError:
    return RuntimeError("The Kafka source needs the spark-sql-kafka connector on the classpath "
                        f"(spark.jars.packages): {exc}")


def read_kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Streaming Kafka records (key, value as BINARY, topic, partition, ...)."""
    try:
        return spark.readStream.format("kafka").options(**options).load()
    except Exception as exc:  # noqa: BLE001 - re-raised with guidance
        if "kafka" in str(exc).lower():
            raise _need_kafka(exc) from exc
        raise


def read_kafka_text(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Batch inspection of a topic: key and value as text, earliest to
    latest (the console-consumer use, as a bounded DataFrame)."""
    opts = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    opts.setdefault("endingOffsets", "latest")
    try:
        df = spark.read.format("kafka").options(**opts).load()
    except Exception as exc:  # noqa: BLE001
        if "kafka" in str(exc).lower():
            raise _need_kafka(exc) from exc
        raise
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp")


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Publish envelopes (`key`, `value` text columns) to a topic."""
    (df.select(F.col("key").cast("string"), F.col("value").cast("string"))
       .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
       .option("topic", topic).save())


def read_envelope_files(spark: SparkSession, path: str,
                        max_files_per_trigger: int | None = 1) -> DataFrame:
    """Stream of JSON-lines envelope files as a `value` text column (the
    file stand-in for the Kafka source)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return r.load(path)


def write_envelope_files(readings: DataFrame, path: str, n_files: int,
                         ts_col: str = "processing_timestamp") -> None:
    """Write flat readings as envelope JSON lines in ``n_files`` files that
    are ordered in time (file i holds an earlier time range than file i+1),
    the order a poller would publish them."""
    env = envelope.encode_envelope(readings.repartitionByRange(n_files, F.col(ts_col))
                                   .sortWithinPartitions(ts_col))
    env.select("value").write.mode("overwrite").text(path)


def order_files_by_name(path: str) -> None:
    """Give local files increasing modification times in name order, so a
    file stream picks them up in that order (test helper; local paths only)."""
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    base = 1_600_000_000
    for i, n in enumerate(names):
        os.utime(os.path.join(path, n), (base + i, base + i))


def decode_stream(raw: DataFrame, mode: str = P.AS_WRITTEN, keep_raw: bool = True) -> DataFrame:
    """`value` (text or bytes) -> flat readings; with ``keep_raw`` the
    envelope text is kept as `_raw` for the dead-letter split."""
    v = F.col("value")
    if dict(raw.dtypes).get("value") == "binary":
        v = v.cast("string")
    dec = raw.select(v.alias("_raw"), F.from_json(v, S.ENVELOPE_DATA_ONLY).alias("_env"))
    data = dec.select("_raw", "_env.data.*")
    return envelope.flatten_reading(data, mode, keep=("_raw",) if keep_raw else ())
