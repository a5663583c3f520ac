"""Near-duplicate documents by MinHash, odd sketches and exact confirmation.

A document's set holds its distinct w-word shingles (words are lower-cased
A-Z runs of non-space bytes; with fewer words the whole sequence is the one
shingle; without words the set is empty and the document links with nothing).
Documents with the same word sequence form one class, found by a grouping
that combines copies in every map task, and a class takes part once.

1. Each class gets ``bands * rows`` MinHash samples; classes that agree on all
   samples of a band share a bucket. With 32 bands of 5 rows a pair at
   similarity 0.8 shares none with probability 3e-6, a more similar one less.
2. *Star round.* Every member of a bucket is paired with the bucket's smallest
   class only, so a bucket of m members gives m - 1 pairs. Confirmed pairs are
   joined into components.
3. *Rest round.* Only buckets that still hold several components are looked at,
   and in them only pairs across components. A bucket's members are dealt into
   blocks of at most ``block`` members; each task compares the *odd sketches* of
   two blocks and lets only pairs through that may reach the threshold, so what
   is written are near misses and links, not all pairs, and no task holds a
   whole bucket.
4. Pairs are confirmed on the full sets of shingle hashes (64 bits) by integer
   arithmetic, after a look at their odd sketches.

An odd sketch folds ``samples`` MinHash samples, the smallest hashes of the set
(all of a smaller set), into a bitmap: each value flips one bit. The bits in
which two sketches differ bound from below how many samples differ, and so tell
which pairs cannot reach the threshold.

Components come from alternating large-star and small-star steps on the
confirmed links, staged in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import memo
from .common import Words, list_array, mix64, pieces, small_batches, staged, text_bytes


@dataclass(frozen=True)
class Settings:
    shingle: int = 2
    percent: int = 80          # link when 100 * |A & B| >= percent * |A | B|
    bands: int = 32
    rows: int = 5
    samples: int = 4096
    sketch_bits: int = 2048
    seed: int = 7
    block: int = 4096

    def most_bits(self, a: np.ndarray, b) -> np.ndarray:
        """Differing bits that the sketches of sets of a and b shingles at the
        threshold cannot exceed. Differing bits never outnumber differing
        samples, and samples that are whole sets leave nothing to chance; where
        they are not, or bits are crowded, five deviations are allowed."""
        share, k = self.percent / 100, self.samples
        common = np.ceil(share * (a + b) / (1 + share) - 1e-9)
        rate = np.minimum(1, k / np.maximum(a, b))
        same = rate * common - 5 * np.sqrt(rate * (1 - rate) * common)
        differ = np.minimum(a, k) + np.minimum(b, k) - 2 * np.maximum(same, 0)
        mean = self.sketch_bits / 2 * (1 - (1 - 2 / self.sketch_bits) ** differ)
        return np.minimum(differ, mean + 5 * np.sqrt(np.maximum(differ - mean, 0) + 1))


def _whole_texts(column: pa.Array) -> Iterator[tuple]:
    """(text number, word hashes of the whole text) for each text.
    Long texts come in pieces; their words are put together again."""
    buf, off = text_bytes(column)
    held: tuple[int, list] | None = None
    for first, part, offsets in pieces(buf, off):
        words = Words(part, offsets)
        bounds = np.searchsorted(words.doc, np.arange(len(offsets)))
        for k in range(len(offsets) - 1):
            own = words.hash[bounds[k]:bounds[k + 1]]
            if held and held[0] == first + k:
                held[1].append(own)
                continue
            if held:
                yield held[0], np.concatenate(held[1])
            held = (first + k, [own])
    if held:
        yield held[0], np.concatenate(held[1])


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one word sequence."""
    if not len(words):
        return words
    width = min(width, len(words))
    mixed = words[:len(words) - width + 1].copy()
    for k in range(1, width):
        mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15)
                      + words[k:len(words) - width + 1 + k])
    return np.unique(mixed)


def _signer(settings: Settings):
    bands, rows = settings.bands, settings.rows
    rng = np.random.default_rng(settings.seed)
    mult = (rng.integers(0, 1 << 31, (bands * rows, 1), np.uint32) << np.uint32(1)) | np.uint32(1)
    add = rng.integers(0, 1 << 32, (bands * rows, 1), np.uint32)
    place = np.arange(bands * rows, dtype=np.uint64)

    def run(batches):
        memo.release()
        for batch in small_batches(batches, "text", 4 << 20):
            n = batch.num_rows
            if not n:
                continue
            digest, size = [None] * n, np.zeros(n, np.int64)
            sample = np.zeros((n, bands * rows), np.uint32)
            for i, words in _whole_texts(batch.column("text")):
                if not len(words):
                    continue
                digest[i] = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
                own = _set_of(words, settings.shingle)
                size[i] = len(own)
                low = (own & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                least = (low[:4096] * mult + add).min(axis=1)
                for at in range(4096, len(low), 4096):
                    np.minimum(least, (low[at:at + 4096] * mult + add).min(axis=1), out=least)
                sample[i] = least
            mixed = mix64((sample.astype(np.uint64) << np.uint64(16)) + place)
            band = mixed.reshape(n, bands, rows)
            key = band[:, :, 0].copy()
            for r in range(1, rows):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + band[:, :, r])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digest, pa.binary()), pa.array(size),
                 list_array(key.ravel().view(np.int64), np.full(n, bands), pa.int64())],
                ["doc_id", "key", "n_shingles", "bands"])
    return run


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, key (128-bit digest of the word sequence, null without words),
    n_shingles and bands (one bucket key each; the band's number is mixed in)
    of every document."""
    return docs.select("doc_id", "text").mapInArrow(
        _signer(settings), "doc_id long, key binary, n_shingles long, bands array<long>")


def odd_sketch(own: np.ndarray, settings: Settings) -> np.ndarray:
    """Bitmap of the smallest hashes (the MinHash samples) of a sorted set."""
    place = mix64(own[:settings.samples]) % np.uint64(settings.sketch_bits)
    flips = np.bincount(place.astype(np.int64), minlength=settings.sketch_bits)
    return np.packbits((flips & 1).astype(np.uint8))


def _sets(settings: Settings):
    def run(batches):
        memo.release()
        for batch in small_batches(batches, "text", 4 << 20):
            ids = batch.column("class_id").to_numpy(zero_copy_only=False)
            for i, words in _whole_texts(batch.column("text")):
                if not len(words):
                    continue
                own = _set_of(words, settings.shingle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]], pa.int64()), pa.array([len(own)], pa.int32()),
                     pa.array([odd_sketch(own, settings).tobytes()], pa.binary()),
                     pa.array([own.tobytes()], pa.binary())],
                    ["class_id", "n", "sketch", "shingles"])
    return run


def shingle_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(class_id, n, sketch, shingles: the n sorted distinct 64-bit hashes) of
    the documents whose id is in ``wanted`` (class_id)."""
    return (docs.select(F.col("doc_id").alias("class_id"), "text")
            .join(wanted, "class_id", "left_semi")
            .mapInArrow(_sets(settings), "class_id long, n int, sketch binary, shingles binary"))


def _bits(raw: pa.Array, settings: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(raw.to_pylist()), np.uint64).reshape(-1, settings.sketch_bits // 64)


def _same_size(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether set sizes allow the threshold at all."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _confirmer(settings: Settings):
    percent = settings.percent

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            far = np.bitwise_count(_bits(batch.column("ka"), settings)
                                   ^ _bits(batch.column("kb"), settings)).sum(axis=1, dtype=np.int64)
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            near = (far <= settings.most_bits(na, nb)) & _same_size(na, nb, percent)
            a, b = batch.column("sa"), batch.column("sb")
            for i in np.flatnonzero(near):
                x = np.frombuffer(a[int(i)].as_buffer(), np.uint64)
                y = np.frombuffer(b[int(i)].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("y")], ["x", "y"]).filter(pa.array(near))
    return run


def confirm(pairs: DataFrame, sets: DataFrame, settings: Settings, shares: int = 64) -> DataFrame:
    """Links (x, y) among distinct pairs, by their full sets. The pairs of a
    busy x are dealt over ``shares`` by y and its set is sent once to each
    share, so one hub is compared by many tasks."""
    busy = (pairs.groupBy("x").count().filter(F.col("count") > 4 * shares)
            .select("x", F.lit(shares).alias("shares")))
    dealt = (pairs.join(busy, "x", "left").select(
        "x", "y", F.when(F.col("shares").isNotNull(), F.pmod(F.hash("y"), F.lit(shares)))
        .otherwise(F.lit(0)).alias("share")))
    hubs = (pairs.select("x").distinct().join(busy, "x", "left")
            .join(sets.toDF("x", "na", "ka", "sa"), "x")
            .withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)))
            .drop("shares"))
    return (dealt.join(sets.toDF("y", "nb", "kb", "sb"), "y").join(hubs, ["x", "share"])
            .select("x", "y", "na", "nb", "ka", "kb", "sa", "sb")
            .mapInArrow(_confirmer(settings), "x long, y long").distinct())


def _rest_finder(settings: Settings):
    """Compares the rows of one block pair, which come one after the other."""

    def compare(run: pa.Table):
        side = run.column("side").to_numpy()
        ids, own = run.column("class_id").to_numpy(), run.column("component").to_numpy()
        n = run.column("n").to_numpy().astype(float)
        bits = _bits(run.column("sketch").combine_chunks(), settings)
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if (side == 1).any() else left
        if run.column("i")[0].as_py() != run.column("j")[0].as_py() and not (side == 1).any():
            return
        for at in left:
            far = np.bitwise_count(bits[right] ^ bits[at]).sum(axis=1, dtype=np.int64)
            near = right[(far <= settings.most_bits(n[right], n[at])) & (own[right] != own[at])
                         & _same_size(n[right], n[at], settings.percent)]
            if right is left:
                near = near[near > at]
            if len(near):
                a, b = ids[near], np.full(len(near), ids[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["x", "y"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if last is not None and (key[:, a] != last).any():
                    yield from compare(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(int(a), int(b - a)))
                last = key[:, a]
        if held:
            yield from compare(pa.Table.from_batches(held))
    return run


def rest_pairs(live: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs across components of the bucket entries ``live`` (bucket,
    class_id, component) that their odd sketches do not rule out. Block pairs
    (i, j), i <= j, of a bucket go to tasks of their own."""
    blocks = (live.groupBy("bucket").agg(F.count("*").alias("m"))
              .select("bucket", F.ceil(F.col("m") / settings.block).cast("int").alias("blocks")))
    at = (live.join(blocks, "bucket")
          .withColumn("k", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")))
    goes = F.expr("transform(sequence(0, blocks - 1), o -> struct("
                  "least(o, k) AS i, greatest(o, k) AS j, if(k <= o, 0, 1) AS side))")
    dealt = (at.withColumn("g", F.explode(goes))
             .select("bucket", "g.i", "g.j", "g.side", "class_id", "component")
             .join(sets.select("class_id", "n", "sketch"), "class_id"))
    return (dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .select("bucket", "i", "j", "side", "class_id", "component", "n", "sketch")
            .mapInArrow(_rest_finder(settings), "x long, y long").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of the undirected links (x, y), the
    smallest node it reaches. Large-star and small-star steps alternate until
    every edge points at its component's smallest node; minima are combined on
    the map side and each round is staged in the shared folder."""
    edges = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")
                         ).filter("u > v").distinct()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.*").filter("u > v").distinct())
        edges = staged(small, "dup-stars")
        ends = edges.select(F.explode(F.array(
            F.struct(F.col("u").alias("n"), F.lit(True).alias("low_end"), F.col("v").alias("to")),
            F.struct(F.col("v").alias("n"), F.lit(False).alias("low_end"), F.lit(None).cast("long").alias("to"))
        )).alias("e")).select("e.*")
        unsettled = ends.groupBy("n").agg(
            F.bool_or("low_end").alias("a"), F.bool_and("low_end").alias("b"),
            F.min("to").alias("lo"), F.max("to").alias("hi")).filter("a <> b OR lo < hi")
        if unsettled.isEmpty():
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionByName(edges.select(F.col("v").alias("node"),
                                              F.col("v").alias("component")).distinct()))


def _several(entries: DataFrame, of: str) -> DataFrame:
    """Buckets whose entries have more than one value of ``of``, and the least."""
    return (entries.groupBy("bucket").agg(F.min(of).alias("least"), F.max(of).alias("most"))
            .filter("least < most").select("bucket", "least"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id,
    n_shingles, component_id (smallest doc_id that the row reaches), kept
    (doc_id = component_id).

    Null or empty texts, or texts of white space, have n_shingles 0 and are
    their own component. Repeated rows with one doc_id are one document; if
    their texts differ, it links with whatever one of them links with. A null
    doc_id links nothing (component_id null, kept true). An empty table gives
    an empty result. Other columns are not read.
    """
    info = staged(signatures(docs, settings), "dup-signed")
    members = info.filter("key IS NOT NULL AND doc_id IS NOT NULL")
    reps = staged(members.groupBy("key").agg(F.min("doc_id").alias("class_id")), "dup-classes")
    entries = (members.select("key", "doc_id", "bands").join(reps, "key").filter("doc_id = class_id")
               .select("class_id", F.explode("bands").alias("bucket")))
    entries = staged(entries, "dup-entries")
    # star round: each bucket's members against its smallest class
    stars = staged(entries.join(_several(entries, "class_id"), "bucket"), "dup-buckets")
    sets = staged(shingle_sets(docs, stars.select("class_id").distinct(), settings), "dup-sets")
    pairs = staged(stars.filter("class_id > least").select(
        F.col("least").alias("x"), F.col("class_id").alias("y")).distinct(), "dup-pairs")
    links = staged(confirm(pairs, sets, settings), "dup-links")
    label = components(links)
    # rest round: across the components that a bucket still holds
    at = staged(stars.select("bucket", "class_id").distinct()
                .join(label, F.col("class_id") == label.node, "left")
                .select("bucket", "class_id", F.coalesce("component", "class_id").alias("component")), "dup-at")
    live = at.join(_several(at, "component").select("bucket"), "bucket", "left_semi")
    pairs = staged(rest_pairs(live, sets, settings), "dup-pairs")
    links = staged(links.unionByName(confirm(pairs, sets, settings)), "dup-links")
    label = components(links)
    found = (members.select("key", "doc_id").join(reps, "key")
             .join(label, F.col("class_id") == label.node, "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("component", "class_id")).alias("found")))
    return (info.select("doc_id", "n_shingles").join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
