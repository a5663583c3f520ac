"""Near duplicates against all pairs."""

import random

import numpy as np
import pytest

from meteoframe.llm import near_dup
from meteoframe.llm.queries import QUERIES, ORACLE
from tests.oracle_check import compare, duck

S = near_dup.Settings()


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 2]) for i in range(max(len(w) - 1, 1))} if w else set()


def brute(rows):
    """{doc_id: (n_shingles of each of its texts, component)} over all pairs."""
    rows = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                a2, b2 = sorted((find(a), find(b)))
                parent[b2] = a2
    return sorted(((d, len(s), find(d) if d is not None else None, d is None or find(d) == d)
                   for d, s in rows), key=repr)


def altered(words, rng, share):
    return [w if rng.random() > share else f"x{rng.randrange(10 ** 6)}" for w in words]


def corpus(seed, families=12, copies=14):
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 40, 150, 600]))]
        for _ in range(copies):
            share = rng.choice([0, 0, 0.01, 0.03, 0.05, 0.08, 0.15])
            rows.append((rng.randrange(1, 10 ** 9), " ".join(altered(base, rng, share))))
    return rows


@pytest.mark.parametrize("seed, settings", [(1, S), (2, near_dup.Settings(block=5)), (3, near_dup.Settings(samples=32))])
def test_same_components_as_all_pairs(spark, seed, settings):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in near_dup.near_duplicates(df, settings).collect()), key=repr)
    assert got == brute(rows)


def test_edge_rows(spark):
    long = "alpha beta gamma delta " * 30_000
    rows = [(10, None), (11, ""), (12, " \n\t"), (13, "One"), (9, "one"), (14, "a b"), (15, "A\tb "), (7, long),
            (8, long + "omega"), (20, "p q r s t"), (20, "p q r s t"), (21, "p q r s t u v w x y z"),
            (None, "a b"), (None, None), (30, "k l m n"), (30, "zz yy xx"), (31, "zz yy xx")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, kept int")
    got = sorted((tuple(r) for r in near_dup.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(0)
    for size in (5, 60, 500, 6000, 30_000):
        for _ in range(30):
            small = int(size * rng.uniform(0.8, 1))
            common = min(small, int(np.ceil(0.8 / 1.8 * (size + small))))
            pool = rng.permutation(np.unique(rng.integers(0, 1 << 64, size + small - common, np.uint64)))
            a, b = np.sort(pool[:size]), np.sort(np.concatenate([pool[:common], pool[size:]]))
            differ = np.bitwise_count(near_dup.odd_sketch(a, S) ^ near_dup.odd_sketch(b, S)).sum()
            assert differ <= S.most_bits(np.array([float(len(a))]), float(len(b)))[0]


def test_components_of_chains_and_cycles(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (300, 100), (500, 400)]
    got = dict(near_dup.components(spark.createDataFrame(links, "x long, y long")).collect())
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100, 400: 400, 500: 400}


def test_query_matches_oracle(spark):
    sf = "/root/testdata/sf0.001"
    name = "op7_near_duplicates"
    r = compare(spark, name, QUERIES[name], ORACLE[name], sf, duck(sf))
    assert r["status"] == "ok", r
