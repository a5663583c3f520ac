"""Vector codes: Orchard's walk against every distance, codebooks by plain code."""

import hashlib
import math

import numpy as np
import pytest

from meteoframe.llm import vector_codes as V
from meteoframe.llm.queries import op13_vector_codes


def nearest(points, book):
    d = ((points[:, None] - book[None]) ** 2).sum(axis=-1)
    return d.argmin(axis=1), d.min(axis=1)


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label) -> rows of the contract, with Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([v for _, v, _ in kept], object).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            own, _ = nearest(x[:, p], books[p])
            for e in range(len(books[p])):
                if (own == e).any():
                    books[p][e] = x[own == e, p].sum(axis=0) // int((own == e).sum())
    found = [nearest(x[:, p], books[p]) for p in range(parts)]
    errors = [sum(int(f[1][r]) for f in found) for r in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    text = ",".join(str(c) for b in books for c in b.ravel())
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i or -1), "".join(f"{f[0][r]:02x}" for f in found), errors[r], by_label[label], sha)
                  for r, (i, _, label) in enumerate(kept))


def rows_of(df):
    return sorted((r.vec_id or -1, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("spread", [1, 2, 3, 1000])
def test_walk_finds_the_nearest(spread):
    """Small spreads give many ties and equal entries."""
    rng = np.random.default_rng(spread)
    for k in (1, 2, 16, 40):
        book = rng.integers(-spread, spread + 1, (k, 3)).astype(np.int64)
        points = rng.integers(-2 * spread, 2 * spread + 1, (500, 3)).astype(np.int64)
        entry, d2 = V.Orchard(book)(points)
        want, least = nearest(points, book)
        assert (entry == want).all() and (d2 == least).all()


def test_largest_values_fit():
    top = V.MOST
    book = np.array([[top] * 500, [-top] * 500, [0] * 500], np.int64)
    entry, d2 = V.Orchard(book)(np.array([[-top] * 500, [1] * 500, [top] * 500], np.int64))
    assert entry.tolist() == [1, 2, 0] and d2.tolist() == [0, 500, 0]


def test_walk_skips_far_entries(monkeypatch):
    """Well separated entries: most are never looked at."""
    rng = np.random.default_rng(0)
    book = rng.integers(-10**6, 10**6, (16, 8)).astype(np.int64)
    points = book[rng.integers(0, 16, 4000)] + rng.integers(-1000, 1000, (4000, 8))
    orchard = V.Orchard(book)
    looked = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                looked.append(len(key))
            return np.asarray(super().__getitem__(key))
    orchard.book = book.view(Counting)
    entry, _ = orchard(points)
    assert (entry == nearest(points, book)[0]).all()
    assert sum(looked) < 0.8 * 15 * len(points)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = op13_vector_codes(spark, sf)
    assert rows_of(got) == brute(rows)


def test_edge_rows(spark):
    rng = np.random.default_rng(1)
    nan, inf = float("nan"), float("inf")
    rows = [(int(i), rng.normal(size=8).tolist(), int(i) % 3 if i % 5 else None) for i in rng.permutation(200) + 5]
    rows += [(1, None, 1), (2, [nan] + [0.0] * 7, 1), (3, [0.0] * 7 + [-inf], 1), (4, [None] * 8, 1)]
    rows += [(7, [0.5] * 8, 1), (7, [0.25] * 8, 1), (None, [0.0] * 8, None), (None, [0.0] * 8, 9)]
    rows += [(1000 + i, [0.125] * 8, 1) for i in range(100)]
    schema = "vec_id long, embedding array<double>, label int, code string, error string, ints int"
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], schema)
    assert rows_of(V.compress(df)) == brute(rows)
    assert V.compress(df.limit(0)).collect() == []
    few = rows[:3] + rows[-1:]
    small = spark.createDataFrame([(*r, "x", "y", 1) for r in few], schema)
    assert rows_of(V.compress(small)) == brute(few)
    # another dimension than the first row's takes no part, a part count that does not divide is met by zeros
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.0, 4.0], 1), (3, [1.0], 1), (4, [], 1)],
                                "vec_id long, embedding array<float>, label int")
    assert [(r.vec_id, r.error) for r in V.compress(odd).orderBy("vec_id").collect()] == [(1, 0), (2, 0)]


def test_codes_decode(spark):
    rows = [(i, [float(i % 7), i / 100, 0.0, 1.0, -1.0, i * 0.5, 2.0, 3.0], i % 2) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    kept = V.prepare(df)
    books = V.fit(kept)
    for r in V.encode(kept, books).collect():       # fewer rows than entries: codes lose nothing but the rounding
        assert np.abs(V.decode(r.code, books) - rows[r.vec_id][1]).max() <= 1 / 4096 and r.error == 0
