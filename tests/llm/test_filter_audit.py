"""Filter orders: every order replayed document by document."""

import itertools
import math
import random

import pytest

from meteoframe.llm import filter_audit
from meteoframe.llm.queries import op11_filter_audit

DOCS = "doc_id long, text string, source string, part int, mask string, digest string"
LABELS = "doc_id long, quality int, toxic int, good string"


def brute(docs, labels):
    """Rows of the contract, by applying the filters in every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for d, text, source in docs:
        t = text or ""
        w = t.encode().split()
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in t for c in "#$%&*|"),
                 "E": d is not None and any(o is not None and o < d and (u or "") == t for o, u, _ in docs)}
        rows.append((source or "", {f for f, no in fails.items() if no}, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(left), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def rows_of(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost,
                                               r.toxic_lost, r.shapley] for r in df.collect()}


def fixture():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)] + ["Ä", "ß\x0b", "A", "BIG", "x#y", " "]
    texts = [None, "", " \t\n", "$", "A" * 30, "é" * 19 + "E", "é" * 20 + "E", " ".join(f"u{i}" for i in range(50)),
             " ".join(f"u{i}" for i in range(49)), " ".join(f"u{i % 65}" for i in range(100)),
             " ".join(f"u{i % 64}" for i in range(100)), " ".join(f"Case case{i % 50}" for i in range(80))]
    texts += [" ".join(rng.choices(words[:rng.choice([40, 206])], k=rng.choice([3, 60, 150]))) for _ in range(40)]
    rows = [(i, rng.choice(texts), rng.choice([None, "", "s1", "s2", "only"])) for i in range(150)]
    rows += [(rng.choice([None, 7, 9]), rng.choice(texts[:6]), "s1") for _ in range(20)]
    rows += [(149, "$", s) for s in ("s1", "s2", "s2")] + [(500 + i, "hot copy", "s1") for i in range(80)]
    labels = [(i, rng.choice([0, 1, None, 2]), rng.choice([0, 1, None])) for i in range(0, 600, 2)]
    return rows, labels + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]


def test_orders_against_replay(spark):
    rows, labels = fixture()
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS)
    marks = spark.createDataFrame([(*r, "z") for r in labels], LABELS)
    want = brute(rows, labels)
    assert len(want) == 4 * 120 * 5
    assert rows_of(filter_audit.audit(docs, marks)) == want
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert rows_of(filter_audit.audit(docs, marks.limit(0))) == brute(rows, [])


def test_query_against_replay(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert rows_of(op11_filter_audit(spark, sf)) == brute(rows, labels)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_lattice_counts_orders(n):
    found = {(e.state, e.filter): e.orders for e in filter_audit.lattice(n)}
    assert len(found) == n << (n - 1)
    for (state, f), orders in found.items():
        size = bin(state).count("1")
        assert orders == math.factorial(size) * math.factorial(n - size - 1)
    for f in range(n):
        assert sum(o for (_, g), o in found.items() if g == f) == math.factorial(n)
