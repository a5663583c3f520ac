"""Nearest neighbours by collision-counting hashing.

Every vector is projected on ``lines`` random directions; on each line the
projections are kept as a sorted array, the only index there is. A query's
window on a line is centred on its own projection. Windows grow by virtual
rehashing: at radius R a window reaches R times the first reach to either side, R
being raised by ``ratio`` in every step, so that no wider hash table is ever
built. A vector inside the query's window on a line collides once; whoever
collides on at least ``threshold`` of the lines is verified by the exact
distance. A query ends when ``k`` verified vectors lie within what its radius
guarantees, or when ``k`` plus a share ``verify`` of the vectors are verified.

Vectors are dealt into blocks by a hash of the id, queries into groups; a task
builds the arrays of one block and answers one group on it, and the blocks'
nearest are merged per query by a grouping. No task holds all vectors or all
queries; the directions come from a seed.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged


@dataclass(frozen=True)
class Settings:
    k: int = 10
    lines: int = 96
    ratio: float = 1.2
    share: float = 0.75        # collisions asked for, as a share of the lines
    margin: float = 1.5        # deviations of the collision count allowed for
    verify: float = 0.15       # share of the vectors verified before a query ends,
    least: int = 100           # with so many more and k
    block: int = 8192          # vectors in a block, about
    group: int = 1024          # queries in a group, about
    seed: int = 11


def usable(vector: Column) -> Column:
    """Not null, of finite components only, and not zero."""
    return F.coalesce(
        vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))


def directions(dim: int, settings: Settings) -> np.ndarray:
    return np.random.default_rng([settings.seed, dim]).standard_normal((dim, settings.lines))


class Block:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        self.ids, self.vectors, self.settings = ids, vectors, settings
        self.lines = directions(vectors.shape[1], settings)
        at = np.ascontiguousarray((vectors @ self.lines).T)
        self.order = np.argsort(at, axis=1, kind="stable")
        self.sorted = np.take_along_axis(at, self.order, axis=1)
        #: the first window reaches as far as a line's middle half is wide
        quarter, three = np.quantile(self.sorted, [0.25, 0.75], axis=1)
        self.first = max(float((three - quarter).mean()) / 2, 1e-12)
        deviation = (settings.share * (1 - settings.share) / settings.lines) ** 0.5
        #: a vector at distance d is seen at a reach of d times this: its offset
        #: on a line is a normal deviate times d
        self.seen = NormalDist().inv_cdf(
            (1 + min(settings.share + settings.margin * deviation, 0.999)) / 2)

    def nearest(self, own: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the block's nearest found, nearest first."""
        s, n = self.settings, len(self.ids)
        centre = query @ self.lines
        need = max(1, int(np.ceil(s.share * s.lines)))
        collisions = np.zeros(n, np.int64)
        done = self.ids == own                        # its own row takes no part
        left = n - int(done.sum())
        low = [int(np.searchsorted(line, c)) for line, c in zip(self.sorted, centre)]
        high = list(low)
        found, far = [np.zeros(0, np.int64)], [np.zeros(0)]
        reach, verified, budget = self.first, 0, s.k + s.least + int(np.ceil(s.verify * n))
        while verified < left:
            rings = []                                # what the wider windows add
            for j, (line, order) in enumerate(zip(self.sorted, self.order)):
                a, b = line.searchsorted((centre[j] - reach, centre[j] + reach)).tolist()
                a, b = min(a, low[j]), max(b, high[j])
                rings += [order[a:low[j]], order[high[j]:b]]
                low[j], high[j] = a, b
            collisions += np.bincount(np.concatenate(rings), minlength=n)
            new = np.flatnonzero((collisions >= need) & ~done)
            if len(new):
                done[new] = True
                verified += len(new)
                found.append(new)
                far.append(np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1)))
            if verified >= budget:
                break
            near = np.concatenate(far)
            if len(near) >= s.k and np.partition(near, s.k - 1)[s.k - 1] * self.seen <= reach:
                break
            reach *= s.ratio
        at, near = np.concatenate(found), np.concatenate(far)
        best = np.lexsort((self.ids[at], near))[:s.k]
        return self.ids[at][best], near[best]


def _answer(settings: Settings):
    def run(key, rows):
        ids = rows.column("vec_id").to_numpy()
        ask = rows.column("is_query").to_numpy(zero_copy_only=False)
        vectors = np.array(rows.column("embedding").to_pylist(), float)
        out_q, out_v, out_d = [], [], []
        if (~ask).any() and ask.any():
            block = Block(ids[~ask], vectors[~ask], settings)
            for own, query in zip(ids[ask], vectors[ask]):
                found, far = block.nearest(own, query)
                out_q.append(np.full(len(found), own))
                out_v.append(found)
                out_d.append(far)
        cat = (lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t))
        return pa.table({"query_id": cat(out_q, np.int64), "vec_id": cat(out_v, np.int64),
                         "score": cat(out_d, float)})
    return run


def nearest(vectors: DataFrame, is_query: Column, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each usable query row of
    ``vectors`` (vec_id, embedding) its ``k`` nearest found among all other
    usable rows of the same length (all, if fewer), by Euclidean distance in
    double precision on the original vectors, ties to the smaller vec_id.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without vec_id. Of repeated rows of one vec_id the least
    vector counts. An empty table gives an empty result. Other columns are not
    read. Recall is measured against brute force in the tests.
    """
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"),
                           is_query.alias("is_query"))
            .filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("is_query").alias("is_query"))
            .withColumn("dim", F.size("embedding")))
    rows = staged(rows, "ann-rows")
    counts = {r["dim"]: (r["n"], r["q"]) for r in rows.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if("is_query").alias("q")).collect()}
    n, q = (max((c[k] for c in counts.values()), default=0) for k in (0, 1))
    blocks, groups = max(1, -(-n // settings.block)), max(1, -(-q // settings.group))
    h = F.xxhash64("vec_id")
    data = (rows.withColumn("block", F.pmod(h, F.lit(blocks)).cast("int"))
            .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
            .withColumn("is_query", F.lit(False)))
    asked = (rows.filter("is_query").withColumn("group", F.pmod(h, F.lit(groups)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    cols = ["dim", "block", "group", "vec_id", "embedding", "is_query"]
    found = (data.select(cols).unionByName(asked.select(cols)).groupBy("dim", "block", "group")
             .applyInArrow(_answer(settings), "query_id long, vec_id long, score double"))
    # each block gives k at most: the merge is bounded by k per block and query
    return (found.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("all"))
            .select("query_id", F.posexplode(F.slice("all", 1, settings.k)).alias("pos", "r"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "r.vec_id", "r.score"))
