"""Session settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results. Event time is read in UTC (the 'Z' in the
# timestamp format is a literal, so the session zone decides the instant).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # malformed event-time text raises (as written) instead of becoming null
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale: adaptive re-planning (runtime broadcast decisions that are
# checked against the measured size, partition coalescing, skew-join splitting).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def sizing(input_bytes: int, partition_bytes: int = 128 << 20) -> dict:
    """Shuffle and scan sizing for an input of ``input_bytes``: about one
    shuffle partition per ``partition_bytes`` of input (AQE coalesces small
    ones at run time and splits skewed ones), and scan splits of the same
    size, so tasks fit executor memory without spilling heavily."""
    n = max(1, -(-int(input_bytes) // int(partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(int(partition_bytes)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(partition_bytes)),
    }


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results on an existing session."""
    for k, v in SEMANTIC_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app: str = "meteoframe",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with our semantic and scale settings.

    On a cluster leave ``master`` as None so spark-submit decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**SEMANTIC_CONF, **SCALE_CONF, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_semantics(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set to shared storage. Only when it is unset
    (local runs and tests) do we make a scratch folder and record it in the
    session so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster; "
                               "a machine-local scratch folder would not survive executor loss")
        d = tempfile.mkdtemp(prefix="meteoframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):")


def is_local_path(path: str) -> bool:
    """A plain path or a ``file:`` URI (as opposed to hdfs:, s3a:, abfss:, ...)."""
    m = _SCHEME.match(path)
    return m is None or m.group(1).lower() == "file"


def join_path(base: str, name: str) -> str:
    """``base/name`` for local paths and URIs alike."""
    return os.path.join(base, name) if is_local_path(base) else f"{base.rstrip('/')}/{name}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for written intermediates.
    Only a local session makes the folder; elsewhere Spark's writers do, on
    the file system that the path names."""
    path = join_path(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    local = _own_disk(spark, path)
    if local:
        os.makedirs(local, exist_ok=True)
    return local or path


def _own_disk(spark: SparkSession, path: str) -> str | None:
    """``path`` without scheme if the driver's disk is the session's file
    system (local master, local path), else None."""
    if not (spark.sparkContext.master or "").startswith("local") or not is_local_path(path):
        return None
    return path[len("file:"):] if path.lower().startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder of data files is there, on any file system."""
    from pyspark.errors import AnalysisException

    local = _own_disk(spark, path)
    if local:
        return os.path.exists(local)
    try:
        spark.read.schema("value string").text(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``, listed (not read) by Spark."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("length"))
    return int(files.agg({"length": "sum"}).first()[0] or 0)


def stage_table(df, name: str):
    """Write ``df`` once as parquet under the checkpoint folder and return a
    DataFrame reading it back.

    Used where one intermediate feeds several branches that Spark cannot
    share (their column pruning differs, so exchanges are not reused): the
    expensive lineage runs once, every branch reads only its columns, and a
    lost executor costs a re-read of shared files, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
