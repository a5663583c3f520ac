"""Sinks: raw JSON rows, write-type coercion, idempotent table writes, JDBC.

Table writes are keyed so a replayed micro-batch overwrites what its first
attempt wrote instead of appending twice:

* raw rows and dead letters get one ``batch_id=<id>`` directory per
  micro-batch, dated tables ``date=D/batch_id=<id>``, replaced on replay;
* derived tables are partitioned by ``date``; touched dates are recomputed
  from the dated tables (or from partial aggregates stored like them) and their
  partitions overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, CharType, DataType, DateType, NumericType, StringType,
                               StructType, TimestampNTZType, TimestampType,
                               VarcharType)

from ..session import path_exists


def raw_json(df: DataFrame, out: str = "data") -> DataFrame:
    """One JSON text per row of the typed flat reading (null fields omitted)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(out))


def coerce_write_types(df: DataFrame, date_cols: Sequence[str] = ("date",),
                       ts_cols: Sequence[str] = ("processing_timestamp",),
                       strict: bool = True) -> DataFrame:
    """Cast the date key to DATE and event time to TIMESTAMP before writing.
    ``strict=False`` uses ``try_cast`` so bad text becomes null."""
    cast = (lambda c, t: F.col(c).cast(t)) if strict else (lambda c, t: F.col(c).try_cast(t))
    adds = {c: cast(c, "date") for c in date_cols if c in df.columns}
    adds.update({c: cast(c, "timestamp") for c in ts_cols if c in df.columns})
    return df.withColumns(adds) if adds else df


# --------------------------------------------------------------- file tables


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                     sort_by: Sequence[str] = (), clustering: str = "range",
                     observe: tuple | None = None, replace: str = "present",
                     blooms: Mapping[str, int] | None = None) -> None:
    """Write a partitioned table, replacing the partitions present in ``df``
    (idempotent on replay) or, with ``replace="all"``, the whole table. The
    choice is an option of this write, never a setting of the session.

    With ``sort_by`` rows are range-partitioned on (partition columns, sort
    columns): one hot date (or device) is split across many tasks by the
    sort key, while each task still writes a few contiguous files. Without
    it rows are written where they are. ``clustering="hash"`` skips the
    range-boundary sampling job (for bounded inputs such as micro-batches) and
    deals by the partition columns and the leading sort column, ``"partition"``
    by the partition columns alone.
    ``observe`` = (Observation, [aggregate columns]) collects metrics during
    the write job itself, behind any sampling. ``blooms`` names columns that
    get Parquet Bloom filters, with the distinct values expected in a row group.
    """
    out = _cluster(df, partition_by, sort_by, clustering) if sort_by else df
    if observe is not None:
        obs, exprs = observe
        out = out.observe(obs, *exprs)
    mode = {"present": "dynamic", "all": "static"}[replace]
    (out.write.mode("overwrite").option("partitionOverwriteMode", mode).options(**bloom_options(blooms))
     .partitionBy(*partition_by).parquet(path))


def bloom_options(columns: Mapping[str, int] | None) -> dict:
    """Writer options for Bloom filters on ``columns`` (name: distinct values
    expected in a row group). Readers skip a row group whose filter, like its
    least and greatest value, excludes the value that a query asks for."""
    out = {}
    for name, distinct in (columns or {}).items():
        out[f"parquet.bloom.filter.enabled#{name}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{name}"] = str(int(distinct))
    return out


def write_dated(df: DataFrame, path: str, batch_id: int, sort_by: Sequence[str] = (),
                observe: tuple | None = None, date_col: str = "date", clustering: str = "hash",
                blooms: Mapping[str, int] | None = None) -> None:
    """One micro-batch's rows of a table laid out ``date=D/batch_id=K``; a
    replay replaces the same directories. The batch id is a text literal, so
    that generated code does not change from batch to batch."""
    rows = df.withColumn("batch_id", F.lit(str(int(batch_id))))
    write_partitions(rows, path, [date_col, "batch_id"], sort_by, clustering, observe, blooms=blooms)


def read_dates(spark: SparkSession, path: str, dates: Sequence, schema: StructType,
               date_col: str = "date") -> DataFrame:
    """Rows of the given dates of a table laid out by date, with the declared
    ``schema`` (partition columns included). Only those dates' folders are
    listed; dates that were never written give no rows."""
    folders = [f"{path.rstrip('/')}/{date_col}={d if d is not None else '__HIVE_DEFAULT_PARTITION__'}"
               for d in dates]
    found = [f for f in folders if path_exists(spark, f)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def _cluster(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str],
             clustering: str) -> DataFrame:
    keys = [*partition_by, *sort_by]
    if clustering == "partition":
        # one file a partition: tables of a few narrow rows a date
        out = df.repartition(*[F.col(c) for c in partition_by or sort_by])
    elif clustering == "hash":
        # the leading sort column too: one hot date is dealt over many tasks, and
        # adaptive execution puts small ones together
        out = df.repartition(*[F.col(c) for c in [*partition_by, *sort_by[:1]]])
    elif clustering == "range":
        out = df.repartitionByRange(*[F.col(c) for c in keys])
    else:
        raise ValueError(f"clustering must be 'range', 'hash' or 'partition', got {clustering!r}")
    return out.sortWithinPartitions(*keys)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = (), observe: tuple | None = None,
                clustering: str = "range") -> None:
    """Write one micro-batch as directory ``batch_id=<id>`` of a table,
    replacing it if a previous attempt wrote it (idempotent on replay).

    The batch id lives in the path, not in the plan: a literal column would
    change the generated code of every batch and defeat the codegen cache.
    Reading the table root yields ``batch_id`` by partition discovery.
    ``observe`` = (Observation, [aggregate columns]) collects metrics during
    the write job itself; it is attached after the range repartition so
    the boundary-sampling job does not count rows too.

    ``clustering="hash"`` clusters on the partition and sort columns without
    the range-boundary sampling job: right for micro-batches, whose size the
    source's rate limit bounds; ``"range"`` (default) splits a hot key of an
    unbounded batch over many tasks.
    """
    target = f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    out = df
    if sort_by:
        out = _cluster(df, partition_by, sort_by, clustering)
    if observe is not None:
        obs, exprs = observe
        out = out.observe(obs, *exprs)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)


# ---------------------------------------------------------------------- JDBC


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, extra: Mapping[str, str] | None = None) -> dict:
    """Connection options; credentials come from the caller (e.g. the
    environment), never from defaults in code."""
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append",
               num_partitions: int | None = None) -> None:
    """Append (or overwrite) through JDBC; ``num_partitions`` is the number of
    concurrent connections. The rows are dealt out for the write alone: the
    stages that compute them keep their own parallelism."""
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.format("jdbc").options(**options).mode(mode).save()


def read_jdbc(spark: SparkSession, options: Mapping[str, str], column: str | None = None,
              bounds: tuple | None = None, num_partitions: int = 8) -> DataFrame:
    """A database table (or subquery) through JDBC: in one task, or, with a
    numeric, date or timestamp ``column`` and its ``bounds``, by that many
    ranges of it in parallel (the bounds only place the ranges; rows outside
    them are read too)."""
    opts = dict(options)
    if column is not None:
        low, high = bounds
        opts.update(partitionColumn=column, lowerBound=str(low), upperBound=str(high),
                    numPartitions=str(num_partitions))
    return spark.read.format("jdbc").options(**opts).load()


def probe_schema(spark: SparkSession, options: Mapping[str, str]) -> StructType:
    """Schema of a target table without reading rows (zero-row subquery)."""
    opts = dict(options)
    table = opts.pop("dbtable")
    opts["dbtable"] = f"(SELECT * FROM {table} WHERE 1 = 0) AS probe"
    return spark.read.format("jdbc").options(**opts).load().schema


def _kind(t: DataType) -> str:
    """Types that a database column may take for one another."""
    if isinstance(t, BooleanType):
        return "boolean"
    if isinstance(t, NumericType):
        return "number"
    if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
        return "time"
    if isinstance(t, ArrayType):
        return f"list of {_kind(t.elementType)}"
    return "text" if isinstance(t, (StringType, CharType, VarcharType)) else t.simpleString()


def schema_gaps(actual: StructType, expected: StructType) -> list[str]:
    """Columns the writer sends that the target lacks or holds with another
    kind of type, compared case-insensitively (unquoted SQL names fold case)."""
    have = {f.name.lower(): f.dataType for f in actual.fields}
    out = []
    for f in expected.fields:
        there = have.get(f.name.lower())
        if there is None:
            out.append(f.name)
        elif _kind(there) != _kind(f.dataType):
            out.append(f"{f.name} ({there.simpleString()}, not {f.dataType.simpleString()})")
    return out


def preflight(spark: SparkSession, targets: Mapping[str, tuple[Mapping[str, str], StructType]]) -> dict:
    """Check every target before starting: {name: gaps}. Raises
    on an unreachable target rather than continuing."""
    return {name: schema_gaps(probe_schema(spark, opts), schema)
            for name, (opts, schema) in targets.items()}
