"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

A text is lower-cased, all but letters of the ASCII range become spaces, and
its character n-grams (``grams`` lengths) are hashed to ``buckets``. A feature
is the presence of a bucket. Counts of rows that hold it, by label, come from
*all* training rows: each task adds up arrays of fixed size, and the arrays are
summed in slices by a shuffle. The log-count ratio of a bucket,

    r = log((p + a) / (n1 + 2a)) - log((q + a) / (n0 + 2a)),

scales its feature. Buckets whose presence does not depend on the label beyond
chance (log-likelihood ratio below ``least_evidence``) get ratio 0; all others
are features, ``buckets`` at most, so that what reaches the driver and the tasks
is bounded. Logistic regression with L2 penalty
on the scaled features is fitted on at most about ``sample_rows`` labelled rows
(a documented bound; chosen by a hash of the id, label and text never looked
at); scoring covers every whole text, long ones in overlapping pieces.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import memo
from .common import binary_array, small_batches, staged


@dataclass(frozen=True)
class Settings:
    grams: tuple = (3, 4, 5, 6)
    buckets_log2: int = 20
    slices: int = 64
    smoothing: float = 0.5
    least_evidence: float = 20.0
    sample_rows: int = 20_000
    penalty: float = 1.0
    rounds: int = 60


@dataclass
class Model:
    feature: np.ndarray        # bucket -> feature number, -1 for none
    weight: np.ndarray         # regression weight times log-count ratio
    bias: float
    settings: Settings
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


_SPACED = np.arange(128, dtype=np.uint32)
_SPACED[[c for c in range(128) if not chr(c).isalpha()]] = 0x20
#: Code points handled at once.
_PIECE = 1 << 19
#: Features of sample rows handled at once in the fit.
_CHUNK = 1 << 20


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    return np.where(codes < 128, _SPACED[np.minimum(codes, 127)], codes)


def _buckets(codes: np.ndarray, settings: Settings):
    """(length, bucket at each start) for each n-gram length."""
    step, shift = np.uint32(0x01000193 * 5 + 2 | 1), np.uint32(32 - settings.buckets_log2)
    h, done = codes.copy(), 1
    for n in sorted(settings.grams):
        while done < n:
            h = h[:-1] * step + codes[done:] if len(h) > 1 else h[:0]
            done += 1
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(13)
        yield n, (mixed * np.uint32(0xC2B2AE35) + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) >> shift


def _overlapping(codes: np.ndarray, most: int):
    """Pieces that share one n-gram less a character with the next."""
    step = _PIECE
    for at in range(0, max(len(codes) - most + 1, 1), step):
        yield codes[at:at + step + most - 1]


def _counter(settings: Settings):
    size = 1 << settings.buckets_log2

    def run(batches):
        memo.release()
        held = np.zeros((2, size), np.int32)
        last = np.zeros(size, np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen = []
                for part in _overlapping(_codes(text or ""), max(settings.grams)):
                    got = np.concatenate([b for _, b in _buckets(part, settings)])
                    place = np.arange(len(got))
                    last[got] = place                       # the last of equal buckets stays
                    seen.append(got[last[got] == place])
                held[label, seen[0] if len(seen) == 1 else np.unique(np.concatenate(seen))] += 1
        if held.any():
            for k, part in enumerate(np.split(held, settings.slices, axis=1)):
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([k], pa.int32()),
                    "counts": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})
    return run


def _adder(settings: Settings):
    width = (1 << settings.buckets_log2) // settings.slices

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                own = np.frombuffer(zlib.decompress(raw.as_buffer()), np.int32).reshape(2, width)
                if k in sums:
                    sums[k] += own
                else:
                    sums[k] = own.astype(np.int64)
        for k, total in sums.items():
            held = np.flatnonzero(total.sum(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held + k * width, pa.int64()), pa.array(total[0, held]), pa.array(total[1, held])],
                ["bucket", "q", "p"])
    return run


def _evidence(q: str, p: str, n0: int, n1: int):
    """Log-likelihood ratio of presence against label, as a Column."""
    total = n0 + n1

    def cell(seen, row_sum, col_sum):
        return F.when(seen > 0, seen * F.log(seen * total / (row_sum * F.lit(col_sum)))).otherwise(0.0)

    q, p = F.col(q).cast("double"), F.col(p).cast("double")
    with_it, without = p + q, F.lit(float(total)) - p - q
    return 2 * (cell(p, with_it, float(n1)) + cell(q, with_it, float(n0))
                + cell(float(n1) - p, without, float(n1)) + cell(float(n0) - q, without, float(n0)))


def _features(settings: Settings, sent):
    def run(batches):
        feature = sent.value
        for batch in small_batches(batches, "text"):
            docs, hits = _hits(batch.column("text").to_pylist(), feature, settings)
            counts = np.bincount(docs, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), binary_array(hits.astype(np.int32), counts * 4)],
                ["toxic", "features"])
    return run


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys by a sort (``np.unique`` hashes them, which takes
    far longer for many)."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _hits(texts: list[str | None], feature: np.ndarray, settings: Settings
          ) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the distinct features of each text, in order."""
    most = max(settings.grams)
    found = []
    held: list[np.ndarray] = []
    first, size = 0, 0

    def close(stop: int):
        nonlocal held, size, first
        if held:
            bounds = np.cumsum([0, *map(len, held)])
            codes = np.concatenate(held)
            own = []
            for n, got in _buckets(codes, settings):
                number = feature[got]
                at = np.flatnonzero(number >= 0)
                doc = np.repeat(np.arange(len(held)), np.diff(np.searchsorted(at, bounds)))
                inside = at + n <= bounds[doc + 1]
                own.append((doc[inside] + first) * len(feature) + number[at][inside])
            found.append(_distinct(np.concatenate(own)))
        held, size, first = [], 0, stop

    for i, text in enumerate(texts):
        codes = _codes(text or "")
        if len(codes) > _PIECE:
            close(i)
            for part in _overlapping(codes, most):
                held = [part]
                close(i)
            first = i + 1
            continue
        held.append(codes)
        size += len(codes)
        if size > _PIECE:
            close(i + 1)
    close(len(texts))
    keys = _distinct(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return keys // len(feature), keys % len(feature)


def _fit(rows: Iterable[np.ndarray], labels: Sequence[float], scale: np.ndarray, settings: Settings
         ) -> tuple[np.ndarray, float]:
    """Penalised logistic regression on presence times scale by L-BFGS. A
    feature that no row has stays at 0, its optimum, and takes no part. Rows are
    put together as they come, about ``_CHUNK`` features a part, and ``labels``
    is read when all have come: the driver holds the features once."""
    sizes: list[int] = []
    parts: list[tuple[int, int, np.ndarray]] = []
    seen, waiting = np.zeros(len(scale), bool), []

    def close() -> None:
        part = np.concatenate(waiting).astype(np.int32)
        seen[part] = True
        parts.append((len(sizes) - len(waiting), len(sizes), part))
        waiting.clear()

    size = 0
    for row in rows:
        waiting.append(row)
        sizes.append(len(row))
        size += len(row)
        if size >= _CHUNK:
            close()
            size = 0
    if waiting:
        close()
    held = np.flatnonzero(seen)
    number = np.zeros(len(scale), np.int32)
    number[held] = np.arange(len(held))
    for _, _, part in parts:
        part[:] = number[part]
    sizes, labels = np.array(sizes, np.int64), np.asarray(labels, float)
    own, k, n = scale[held], len(held), len(sizes)

    def loss(w):
        z, slope, value = np.empty(n), np.zeros(k), own * w[:k]
        for a, b, c in parts:
            z[a:b] = np.bincount(np.repeat(np.arange(b - a), sizes[a:b]), value[c], minlength=b - a) + w[k]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        cost = np.logaddexp(0, z).sum() - z[labels == 1].sum() + settings.penalty / 2 * (w[:k] ** 2).sum()
        d = p - labels
        for a, b, c in parts:
            slope += np.bincount(c, np.repeat(d[a:b], sizes[a:b]), minlength=k)
        return cost, np.append(own * slope + settings.penalty * w[:k], d.sum())

    w = np.zeros(k + 1)
    w[k] = np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5))
    cost, grad = loss(w)
    pairs: list[tuple] = []
    for _ in range(settings.rounds):
        q, used = grad.copy(), []
        for s, y, rho in reversed(pairs):
            a = rho * (s @ q)
            used.append(a)
            q -= a * y
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.abs(grad).max())
        for (s, y, rho), a in zip(pairs, reversed(used)):
            q += s * (a - rho * (y @ q))
        step, slope = 1.0, grad @ q
        while True:
            new = w - step * q
            after, after_grad = loss(new)
            if after <= cost - 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, y = new - w, after_grad - grad
        small = abs(cost - after) <= 1e-7 * max(1.0, abs(cost))
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y, 1 / (s @ y))][-10:]
        w, cost, grad = new, after, after_grad
        if small:
            break
    weight = np.zeros(len(scale))
    weight[held] = w[:k] * own
    return weight, float(w[k])


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model from the texts of ``docs`` (doc_id, text) that have a row in
    ``labels`` (doc_id, toxic 0 or 1); None without any. Rows whose label is
    null or else teach nothing; a null text is empty; a document with several
    labels counts for each. Texts meet labels in a shuffle join: once for the
    counts over all rows, once for the sample, which is drawn before."""
    spark = docs.sparkSession
    labels = labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", "text")
    count = {r["toxic"]: r["n"] for r in docs.select("doc_id").join(labels, "doc_id")
             .groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = count.get(0, 0), count.get(1, 0)
    if not n0 + n1:
        return None
    # the same join at every size: labels grow with the table, so no broadcast
    rows = texts.join(labels.hint("merge"), "doc_id").select("text", "toxic")
    parts = rows.mapInArrow(_counter(settings), "slice int, counts binary")
    counts = (parts.repartition(settings.slices, "slice")
              .mapInArrow(_adder(settings), "bucket long, q long, p long"))
    a = settings.smoothing
    ratio = (F.log((F.col("p") + a) / (n1 + 2 * a)) - F.log((F.col("q") + a) / (n0 + 2 * a)))
    best = (counts.withColumn("evidence", _evidence("q", "p", n0, n1)).withColumn("ratio", ratio)
            .filter(F.col("evidence") >= settings.least_evidence).select("bucket", "ratio").toArrow())
    bucket, scale = best["bucket"].to_numpy(), best["ratio"].to_numpy()
    order = np.argsort(bucket)
    feature = np.full(1 << settings.buckets_log2, -1, np.int32)
    feature[bucket[order]] = np.arange(len(order))
    share = min(1.0, settings.sample_rows / (n0 + n1))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)
    sent = spark.sparkContext.broadcast(feature)
    # written by all tasks, then fetched file by file: the driver holds the rows once
    got = staged(texts.filter(drawn).join(labels.filter(drawn).hint("merge"), "doc_id").select("text", "toxic")
                 .mapInArrow(_features(settings, sent), "toxic int, features binary"), "toxicity-sample")
    marks: list[float] = []

    def sample() -> Iterator[np.ndarray]:
        for row in got.toLocalIterator():
            marks.append(row["toxic"])
            yield np.frombuffer(row["features"], np.int32)

    weight, bias = _fit(sample(), marks, scale[order], settings)
    return Model(feature, weight, bias, settings)


def _scorer(sent, keep: list[str]):
    def run(batches):
        model = sent.value
        for batch in small_batches(batches, "text"):
            score = np.zeros(batch.num_rows)
            if model is not None:
                docs, hits = _hits(batch.column("text").to_pylist(), model.feature, model.settings)
                z = np.bincount(docs, model.weight[hits], minlength=batch.num_rows) + model.bias
                score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(score, pa.float64())], [*keep, "score"])
    return run


def score(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row and its score (0 to 1) from the text alone.

    A null or empty text has no features: its score is the model's bias. With
    no model (nothing to learn from) every score is 0. Repeated rows give
    repeated rows, an empty table an empty result. A kept column named ``score``
    gives way to the new one.
    """
    keep = [c for c in keep if c.lower() != "score"]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = StructType([*(rows.schema[c] for c in keep), StructField("score", DoubleType())])
    return rows.mapInArrow(_scorer(sent, keep), schema)
