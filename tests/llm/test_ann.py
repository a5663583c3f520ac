"""Nearest neighbours: recall against brute force, exact scores, edges."""

import math

import numpy as np
import pandas as pd
import pyspark.sql.functions as F

from meteoframe.llm import ann
from meteoframe.llm.queries import op2_nearest_neighbours

QUERY = "vec_id % 100 = 0"


def brute(ids, vectors, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        order = np.lexsort((ids, d))
        out[q] = [(int(ids[i]), d[i]) for i in order if ids[i] != q][:k]
    return out


def check(rows, want, least):
    hits = total = 0
    by = {}
    for r in rows:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    for q, exact in want.items():
        own = sorted(by[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(exact) + 1))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {v for v, _ in exact})
        total += len(exact)
    assert hits / total >= least, hits / total


def test_recall(spark, sf="/root/testdata/sf0.01", least=0.9):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, vectors = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), float)
    got = op2_nearest_neighbours(spark, sf).collect()
    check(got, brute(ids, vectors, [int(i) for i in ids if i % 100 == 0]), least)
    place = {int(i): v for i, v in zip(ids, vectors)}
    for r in got[:200]:
        assert math.isclose(r.score, math.dist(place[r.query_id], place[r.vec_id]), rel_tol=1e-12)


def test_recall_of_many_vectors(spark):
    """Ten clusters and some copies, several blocks of the production settings."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(10, 64))[rng.integers(0, 10, 20_000)] * 0.1 + rng.normal(size=(20_000, 64)) * 0.1
    vectors[5000:5200] = vectors[77]
    ids = np.arange(20_000)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": ids, "embedding": vectors.tolist()}),
                               "vec_id long, embedding array<double>")
    check(ann.nearest(df, F.expr(QUERY)).collect(), brute(ids, vectors, range(0, 20_000, 100)), 0.95)


def test_blocks_and_groups_are_merged(spark):
    rng = np.random.default_rng(0)
    ids = rng.permutation(700)
    vectors = rng.normal(size=(700, 8))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    settings = ann.Settings(block=100, group=3, k=5)
    check(ann.nearest(df, F.expr(QUERY), settings).collect(), brute(ids, vectors, range(0, 700, 100), 5), 0.9)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [0.0, 2.0]), (None, [1.0, 1.0]), (100, [0.0, 0.0]), (200, None), (300, [5.0]), (8, [0.0, 2.0]),
            (9, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted(tuple(r) for r in ann.nearest(df, F.expr(QUERY)).collect())
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 8, math.sqrt(5))]
    assert ann.nearest(df.limit(0), F.expr(QUERY)).count() == 0
