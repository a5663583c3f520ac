"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, join_path

#: ASCII white space, the separators of the contracts' words.
SPACE_CLASS = r"\x20\x09-\x0D"
#: Texts are handled in pieces of about this many bytes, so memory stays flat.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: its
    lineage ends there, so losing an executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = join_path(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(col: str, modulus: int, remainder: int) -> Column:
    """True where crc32(id as text) mod ``modulus`` is ``remainder``; a null id
    has no checksum and counts as not held out."""
    crc = F.crc32(F.col(col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{SPACE_CLASS}]++")), F.lit(0)).cast("long")


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of an Arrow string column without copying
    each text; null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]] if len(col) else buf[:0], off - off[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            p = np.multiply.accumulate(p)
            if k < len(_POWERS):
                _POWERS[k] = p
            else:
                _POWERS.append(p)
    return _POWERS[0], _POWERS[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a run of texts: 64-bit hash of each lower-cased word, the text
    it belongs to, its bounds in ``buf``."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf = buf
        n = len(buf)
        solid = np.empty(n + 1, bool)
        np.logical_not(_IS_SPACE[buf], out=solid[:n])
        solid[n] = False
        cut = np.zeros(n + 1, bool)            # a text starts here
        cut[offsets[:-1]] = True
        before = np.empty(n + 1, bool)
        before[0], before[1:] = False, solid[:n]
        self.starts = np.flatnonzero(solid & (~before | cut))
        self.ends = np.flatnonzero(before & (~solid | cut))
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        if n:
            up, down = _powers(n + 1)
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum((_LOWER[buf].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
            self.hash = mix64((sums[self.ends] - sums[self.starts]) * down[self.starts])
        else:
            self.hash = np.zeros(0, np.uint64)


def _safe_cut(buf: np.ndarray, start: int, stop: int, most: int) -> int:
    """Where to end a piece of one long text: behind a space near start + most,
    or at the next space if there is none before."""
    if stop - start <= most:
        return stop
    spaces = np.flatnonzero(_IS_SPACE[buf[start:start + most]])
    if len(spaces):
        return start + int(spaces[-1]) + 1
    at = start + most
    while at < stop:
        more = np.flatnonzero(_IS_SPACE[buf[at:at + most]])
        if len(more):
            return at + int(more[0]) + 1
        at += most
    return stop


def pieces(buf: np.ndarray, offsets: np.ndarray, most: int = PIECE_BYTES
           ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``most`` bytes as (first text, bytes, offsets).
    A longer text comes in several pieces cut at spaces, each by itself with
    the same text number."""
    n, i = len(offsets) - 1, 0
    while i < n:
        if offsets[i + 1] - offsets[i] > most:
            at, stop = int(offsets[i]), int(offsets[i + 1])
            while at < stop:
                end = _safe_cut(buf, at, stop, most)
                yield i, buf[at:end], np.array([0, end - at], np.int64)
                at = end
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column whose i-th row holds the next counts[i] values."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


def binary_array(data: np.ndarray, byte_counts: np.ndarray) -> pa.Array:
    """Binary column whose i-th row holds the next byte_counts[i] bytes."""
    off = np.zeros(len(byte_counts) + 1, np.int32)
    np.cumsum(byte_counts, out=off[1:])
    flat = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(byte_counts),
                                 [None, pa.py_buffer(off.tobytes()), pa.py_buffer(flat.tobytes())])


def small_batches(batches: Iterable[pa.RecordBatch], column: str, most: int = 2 << 20
                  ) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` text bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_bytes(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


def prefix_sums(df: DataFrame, keys: list[str], order: list[Column], block: str,
                value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the rows of the same ``keys`` before this
    row. Rows are ordered by the integer column ``block`` and then by ``order``
    (which must break all ties); ``keys`` and ``block`` hold no null. Each
    window holds one block of one key; block totals are summed before the
    shuffle and added up on two levels, so that no task sees all rows of a key.
    Rows are shuffled once: join and window share the partitioning."""
    from pyspark.sql import Window

    totals = (df.groupBy(*keys, block).agg(F.sum(value).alias("__t"))
              .withColumn("__big", F.floor(F.col(block) / 1024)))
    above = Window.partitionBy(*keys).orderBy("__big")
    bases = (totals.groupBy(*keys, "__big").agg(F.sum("__t").alias("__b"))
             .withColumn("__b", F.sum("__b").over(above) - F.col("__b")))
    within = Window.partitionBy(*keys, "__big").orderBy(block)
    level = (totals.join(bases, [*keys, "__big"])
             .withColumn("__base", F.col("__b") + F.sum("__t").over(within) - F.col("__t"))
             .select(*keys, block, "__base"))
    inner = Window.partitionBy(*keys, block).orderBy(*order)
    return (df.join(level, [*keys, block])
            .withColumn(out, F.col("__base") + F.sum(value).over(
                inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
            .drop("__base"))
