"""How filters interact: every order of a set of filters, by path counting.

A document's *mask* has a bit for each filter that it fails. Applying filters
one after the other walks the lattice of subsets: a state is the set of filters
applied so far, an edge applies one more, and an order is a path from the empty
set to the full one. What an edge removes depends on its state and filter alone
(documents that pass the state and fail the filter), so a part's masks are
counted once and the 80 edges of five filters answer all 120 orders:

* *forward* counts the orders that reach a state, *backward* those that leave
  it for the end; an edge lies on forward(state) * backward(next state) orders,
  and its removals weighted by that count add up to the filter's Shapley value
  (summed over all orders, not divided by them);
* the steps of one order are read from the edges along its path.

Masks are made in one pass over the texts; afterwards only doc_id, part, mask
and a digest travel. Copies are counted before they are shuffled, so a text or
an id with a third of all rows is a few rows by then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

#: The filters on a text alone, in bit order; the copy filter has the next bit.
FILTERS = "ABCDE"
_COPY = 4
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INSIDE = bytes(range(0x80, 0xC0))          # UTF-8 bytes that continue a code point


@dataclass(frozen=True)
class Limits:
    least_words: int = 50
    distinct_percent: int = 65     # B fails below this share of distinct words
    upper_percent: int = 5         # C fails above this share of A-Z
    symbols: bytes = b"#$%&*|"     # D fails with any of these


def text_mask(text: bytes, limits: Limits = Limits()) -> int:
    """Bits of the filters A to D that a text fails (words are its runs of
    bytes other than ASCII white space, by case)."""
    words = text.split()
    points = len(text.translate(None, _INSIDE))
    upper = len(text) - len(text.translate(None, _UPPER))
    return ((len(words) < limits.least_words)
            | (100 * len(set(words)) < limits.distinct_percent * len(words)) << 1
            | (100 * upper > limits.upper_percent * points) << 2
            | (len(text.translate(None, limits.symbols)) < len(text)) << 3)


def _facts(limits: Limits):
    def run(batches):
        for batch in small_batches(batches, "text"):
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"),
                 pa.array([text_mask(t, limits) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest()[:16] for t in texts], pa.binary())],
                ["doc_id", "part", "mask", "digest"])
    return run


def masks(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(part, mask, good, toxic, n): documents per part, failed filters and
    labels. At most parts * 128 rows.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality, toxic;
    other columns are not read. A null text is empty, a null source the part
    ''. A document is good or toxic if any of its labels is 1. A row without
    doc_id has no labels, no smaller ids and is smaller than none: it never
    fails E. Rows equal in doc_id and text are not copies of each other. Texts
    are compared by 128 bits of their SHA-256.
    """
    facts = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"),
                               F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"))
                   .mapInArrow(_facts(limits), "doc_id long, part string, mask int, digest binary"),
                   "filter-facts")
    known = facts.filter("doc_id IS NOT NULL")
    first = (known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("copy", F.lit(0)))
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.expr("CAST(quality <=> 1 AS INT)")).alias("good"),
                  F.max(F.expr("CAST(toxic <=> 1 AS INT)")).alias("toxic")))
    counted = (known.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
               .join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
               .select("part", F.col("mask").bitwiseOR(F.coalesce("copy", F.lit(1 << _COPY))).alias("mask"),
                       F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "n"))
    unnamed = facts.filter("doc_id IS NULL").select(
        "part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.lit(1).cast("long").alias("n"))
    return counted.unionByName(unnamed).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Edge:
    """Applying filter number ``filter`` in ``state``; ``orders`` go this way."""
    state: int
    filter: int
    orders: int


def lattice(n: int) -> list[Edge]:
    """All edges of the subsets of n filters with the orders through each, by
    counting paths forward from no filter and backward from all."""
    full = (1 << n) - 1
    forward, backward = np.zeros((2, 1 << n), object)
    forward[0] = backward[full] = 1
    out = []
    for state in range(1 << n):
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
                out.append(Edge(state, f, int(forward[state] * backward[state | 1 << f])))
    return out


def _literal_rows(rows: Sequence[tuple], names: Sequence[str]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(r, names)]) for r in rows])


def edges(counts: DataFrame, n: int) -> DataFrame:
    """Per part and edge (state, filter): kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, and shapley of the edge's filter.
    ``counts`` as from ``masks``; every part has all edges."""
    fixed = _literal_rows([(e.state, e.filter, 1 << e.filter, e.orders) for e in lattice(n)],
                          ("state", "filter", "bit", "orders"))
    rows = counts.select("*", F.explode(fixed).alias("e")).select("part", "mask", "good", "toxic", "n", "e.*")

    def total(condition: str, value: str = "n") -> Column:
        return F.sum(F.expr(f"CASE WHEN {condition} THEN {value} ELSE 0 END"))

    gone = "mask & state = 0 AND mask & bit <> 0"
    made = rows.groupBy("part", "state", "filter", "orders").agg(
        total("mask & (state | bit) = 0").alias("kept"),
        total(gone).alias("removed"),
        total("mask & state <> 0 AND mask & bit <> 0").alias("redundant"),
        total("mask = bit").alias("unique_fails"),
        total(gone, "n * good").alias("good_lost"),
        total(gone, "n * toxic").alias("toxic_lost"))
    value = made.groupBy("part", "filter").agg(F.sum(F.expr("orders * removed")).alias("shapley"))
    return made.drop("orders").join(value, ["part", "filter"])


def steps(per_edge: DataFrame, names: str) -> DataFrame:
    """(part, filter_order, step, filter, and what ``edges`` has): every order
    of the filters named by the letters of ``names``, read from the edges."""
    spark = per_edge.sparkSession
    path = []
    for order in permutations(range(len(names))):
        state = 0
        for k, f in enumerate(order):
            path.append((state, f, "".join(names[i] for i in order), k + 1))
            state |= 1 << f
    # n! * n rows, whatever the input
    path = spark.createDataFrame(path, "state int, filter int, filter_order string, step int")
    return (per_edge.join(F.broadcast(path), ["state", "filter"])
            .withColumn("filter", F.substring(F.lit(names), F.col("filter") + 1, F.lit(1))).drop("state"))


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every order and step of the five filters in every part (see ``masks``
    for nulls and repeated rows). No documents give no parts and no rows."""
    counts = staged(masks(docs, labels, limits), "filter-masks")
    return steps(edges(counts, len(FILTERS)), FILTERS).select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")
