"""Vector code compression: product codes whose entries Orchard's search finds.

A vector's components become integers, floor(scale * x); the vector is cut into
equal consecutive parts and each part is coded by its nearest codebook entry
(squared Euclidean distance, ties to the lower index). All arithmetic is in
integers, so every run gives the same codes.

*Orchard search.* For every entry the other entries are listed by distance. A
part starts at one entry and walks down that entry's list; an entry that is
nearer becomes the current one and its list is walked from its start. An entry
is looked at once (marked visited). The walk ends at the first listed entry
farther than twice the current distance from the current entry: by the triangle
inequality it and all behind it are farther from the part than the current
entry. Entries at exactly twice may tie and are still looked at. All parts of a
batch walk at once in numpy, and only unfinished ones take the next step.

Codebooks are fitted on all rows: each round every task walks its rows and
gives sums and counts per entry, a fixed-size table whatever its input, which
Spark adds up; the codebooks alone (parts x entries x width integers) pass
through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import list_array, staged

#: Integers are held within this, so that squared distances fit 64 bits (a
#: component of 16,384 and more; up to 4,000 components).
MOST = 1 << 26
#: Rows that walk at once.
_TOGETHER = 8192
#: Labels with at least this share of the rows are joined by broadcast.
_HOT_SHARE = 1000


@dataclass(frozen=True)
class Settings:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: float = 4096.0


class Orchard:
    """Nearest entries of one codebook (entries x width integers)."""

    def __init__(self, book: np.ndarray):
        self.book = book
        between = ((book[:, None] - book[None]) ** 2).sum(axis=-1)
        k = len(book)
        np.fill_diagonal(between, -1)                       # an entry leads its own list
        order = np.lexsort((np.broadcast_to(np.arange(k), (k, k)), between), axis=-1)
        self.listed = order[:, 1:]
        # a listed distance d2 ends the walk at the current distance c2 if d2 > 4 * c2
        self.ends = (np.take_along_axis(between, self.listed, axis=-1) - 1) // 4

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each row of ``points``."""
        n, k = len(points), len(self.book)
        best = np.zeros(n, np.int64)
        least = ((points - self.book[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        walk = np.arange(n) if k > 1 else np.zeros(0, np.int64)
        lists, at = best.copy(), np.zeros(n, np.int64)     # whose list, and where in it
        reach = least.copy()                                # distance to the list's owner
        while len(walk):
            own, place = lists[walk], at[walk]
            go = self.ends[own, place] < reach[walk]
            walk, own, place = walk[go], own[go], place[go]
            entry = self.listed[own, place]
            at[walk] += 1
            new = ~seen[walk, entry]
            looked, entry = walk[new], entry[new]
            seen[looked, entry] = True
            d2 = ((points[looked] - self.book[entry]) ** 2).sum(axis=1)
            nearer = d2 < least[looked]
            better = nearer | ((d2 == least[looked]) & (entry < best[looked]))
            best[looked[better]], least[looked[better]] = entry[better], d2[better]
            jump = looked[nearer]
            lists[jump], reach[jump], at[jump] = best[jump], least[jump], 0
            walk = walk[at[walk] < k - 1]
        return best, least


def _scaled(settings: Settings):
    """Rows with a whole vector, its components as integers."""
    def run(batches):
        for batch in batches:
            col = batch.column("embedding")
            there = np.asarray(col.is_valid())
            size = pc.list_value_length(col).drop_null().to_numpy(zero_copy_only=False)
            x = col.flatten().to_numpy(zero_copy_only=False).astype(float)       # null: NaN
            wrong = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ends = np.cumsum(size)
            whole = wrong[ends] == wrong[ends - size]
            x = x[np.repeat(whole, size)]
            ints = np.clip(np.floor(settings.scale * np.clip(x, -MOST, MOST)), -MOST, MOST).astype(np.int32)
            rows = batch.take(pa.array(np.flatnonzero(there)[whole]))
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"), list_array(ints, size[whole], pa.int32())],
                ["vec_id", "label", "ints"])
    return run


def _blocks(batches, dim: int, settings: Settings) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, rows x parts x width) of up to _TOGETHER rows at a time."""
    width = -(-dim // settings.parts)
    for batch in batches:
        for start in range(0, batch.num_rows, _TOGETHER):
            rows = batch.slice(start, _TOGETHER)
            held = np.zeros((rows.num_rows, settings.parts * width), np.int64)
            held[:, :dim] = rows.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield rows, held.reshape(rows.num_rows, settings.parts, width)


def _sums(books: np.ndarray, dim: int, settings: Settings):
    def run(batches):
        parts, entries, width = books.shape
        search = [Orchard(b) for b in books]
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for rows, points in _blocks(batches, dim, settings):
            for p in range(parts):
                entry, _ = search[p](points[:, p])
                count[p] += np.bincount(entry, minlength=entries)
                for w in range(width):      # exact: sums of a block stay below 2 ** 53
                    total[p, :, w] += np.bincount(entry, points[:, p, w], entries).astype(np.int64)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.repeat(part, width), pa.int32()),
            "entry": pa.array(np.repeat(entry, width), pa.int32()),
            "place": pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
            "total": pa.array(total[part, entry].ravel(), pa.int64()),
            "n": pa.array(np.repeat(count[part, entry], width), pa.int64())})
    return run


def _codes(books: np.ndarray, dim: int, settings: Settings):
    def run(batches):
        search = [Orchard(b) for b in books]
        digits = np.array([f"{k:02x}" for k in range(max(books.shape[1], 1))])
        for rows, points in _blocks(batches, dim, settings):
            found = [s(points[:, p]) for p, s in enumerate(search)]
            code = digits[np.stack([f[0] for f in found], axis=1)]
            error = sum(f[1] for f in found)
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), rows.column("label"),
                 pa.array(["".join(c) for c in code.tolist()], pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"])
    return run


@dataclass(frozen=True)
class Codebooks:
    """parts x entries x width integers, for vectors of ``dim`` components."""
    books: np.ndarray
    dim: int

    @property
    def sha256(self) -> str:
        """Hash of all components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def prepare(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, label, ints) of every row whose vector holds finite numbers
    only, staged: the rows are read once a round. Further columns are not read."""
    rows = vectors.select(F.col("vec_id").cast("long"), "label", "embedding")
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, ints array<int>"
    return staged(rows.mapInArrow(_scaled(settings), schema), "code-vectors")


def fit(rows: DataFrame, settings: Settings = Settings()) -> Codebooks | None:
    """Codebooks of prepared rows; None without rows.

    The parts of the first ``entries`` rows (by vec_id, null last, ties by
    vector) are the start. The first row sets the dimension. With fewer rows a
    codebook has as many entries as there are rows. A part count that does not
    divide the dimension is met by zeros behind the vector.
    """
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").select("ints", F.size("ints").alias("dim"))
    first = seeds.first()
    if first is None:
        return None
    dim = first["dim"]
    seeds = [r["ints"] for r in seeds.filter(F.col("dim") == dim).limit(settings.entries).collect()]
    rows = rows.filter(F.size("ints") == dim)
    width = -(-dim // settings.parts)
    books = np.zeros((len(seeds), settings.parts * width), np.int64)
    books[:, :dim] = seeds
    books = books.reshape(len(seeds), settings.parts, width).transpose(1, 0, 2).copy()
    for _ in range(settings.rounds):
        got = (rows.select("ints").mapInArrow(_sums(books, dim, settings),
                                              "part int, entry int, place int, total long, n long")
               .groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
        books = books.copy()                 # an entry that no part chose stays
        for r in got:
            books[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    return Codebooks(books, dim)


def encode(rows: DataFrame, codebooks: Codebooks, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, label, code, error) of prepared rows; those of another
    dimension than the codebooks' take no part."""
    schema = StructType([StructField("vec_id", LongType()), rows.schema["label"],
                         StructField("code", StringType()), StructField("error", LongType())])
    return (rows.filter(F.size("ints") == codebooks.dim)
            .mapInArrow(_codes(codebooks.books, codebooks.dim, settings), schema))


def decode(code: str, codebooks: Codebooks, settings: Settings = Settings()) -> np.ndarray:
    """The vector that a code stands for."""
    picked = [codebooks.books[p, int(code[2 * p:2 * p + 2], 16)] for p in range(settings.parts)]
    return np.concatenate(picked)[:codebooks.dim] / settings.scale


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` (staged) with label_error, the sum of ``error`` over rows of an
    equal label, nulls together. Labels that hold a thousandth of all rows are
    at most a thousand and are sent to every task; the others meet their totals
    in a shuffle whose groups are that small."""
    n = coded.count()
    totals = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")),
                    "code-labels").withColumnRenamed("label", "of")
    often = F.col("n") * _HOT_SHARE >= n
    same = F.col("label").eqNullSafe(F.col("of"))
    hot = coded.join(F.broadcast(totals.filter(often).withColumn("hot", F.lit(True))), same, "left")
    rest = (hot.filter("hot IS NULL").select(*coded.columns)
            .join(totals.filter(~often), same))
    columns = [*coded.columns, "label_error"]
    return hot.filter("hot").select(columns).unionByName(rest.select(columns))


def compress(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row
    of ``vectors`` (vec_id, embedding, label) with a whole vector.

    Rows whose vector is null or holds null, NaN or infinite components go;
    repeated rows stay. Equal vectors have equal codes. No rows give no rows.
    """
    rows = prepare(vectors, settings)
    books = fit(rows, settings)
    if books is None:
        return (rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256")))
    coded = staged(encode(rows, books, settings), "codes")
    return label_errors(coded).withColumn("codebooks_sha256", F.lit(books.sha256))
