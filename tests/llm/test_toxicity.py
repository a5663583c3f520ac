"""Toxicity: counts, regression and held-out accuracy."""

import numpy as np

from meteoframe.llm import toxicity
from meteoframe.llm.queries import op4_toxicity

S = toxicity.Settings()


def grams(text):
    """Bucket set of a text, by looking at every n-gram alone."""
    codes = toxicity._codes(text)
    out = set()
    for n in S.grams:
        for i in range(len(codes) - n + 1):
            got = dict(toxicity._buckets(codes[i:i + n], S))
            out.add(int(got[n][0]))
    return out


def test_hits_are_the_distinct_buckets(monkeypatch):
    texts = ["you idiot you", None, "", "ab", "Scum! scum", "é" * 50 + " clown " * 30, "x" * 7]
    feature = np.arange(1 << S.buckets_log2)
    want = [grams(t or "") for t in texts]
    for piece in (1 << 19, 16):
        monkeypatch.setattr(toxicity, "_PIECE", piece)
        docs, hits = toxicity._hits(texts, feature, S)
        for i, w in enumerate(want):
            assert set(hits[docs == i].tolist()) == w


def test_fit_finds_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(300)]
    labels = np.array([float((0 in r) or rng.random() < 0.1) for r in rows])
    scale = np.array([2.0, -1, 1, 0.5, 1, 1])
    weight, bias = toxicity._fit(rows, labels, scale, S)
    x = np.zeros((300, 6))
    for i, r in enumerate(rows):
        x[i, r] = 1
    z = x @ weight + bias
    gradient = (x * scale).T @ (1 / (1 + np.exp(-z)) - labels) + S.penalty * weight / scale
    assert np.abs(gradient).max() < 0.05 and weight[0] > 1


def test_edge_rows(spark):
    rows = [(i, f"a quiet text number {i} about rivers", "x") for i in range(60)]
    rows += [(100 + i, f"you idiot number {i}, you scum", "x") for i in range(40)]
    rows += [(200, None, "x"), (201, "", "x"), (None, "you idiot, you scum", None), (202, "you idiot number, you scum " * 50_000, "x"), (0, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in [*range(60), *range(100, 140)]]
                                   + [(1, None), (None, 1), (2, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {(r.doc_id, r.text_size): r.score for r in toxicity.score(
        docs.selectExpr("doc_id", "text", "coalesce(length(text), -1) AS text_size"), model,
        ["doc_id", "text_size"]).collect()}
    assert len(got) == len(rows)
    assert all(got[(i, len(f"a quiet text number {i} about rivers"))] < 0.5 for i in range(60))
    assert all(v >= 0.5 for (d, _), v in got.items() if d is not None and 100 <= d < 140 or d == 202)
    assert got[(None, 19)] >= 0.5 and got[(200, -1)] == got[(201, 0)] < 0.5
    assert toxicity.train(docs.limit(0), labels) is None
    assert {r.score for r in toxicity.score(docs.select("doc_id", "text"), None, ["doc_id"]).collect()} == {0.0}


def test_all_buckets_with_evidence_are_features(spark):
    rng = np.random.default_rng(0)
    often, seldom = (["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(n)] for n in (600, 40))
    rows = [(i, f"a quiet text number {i} about rivers", 0) for i in range(200)]
    rows += [(300 + i, " ".join(often), 1) for i in range(30)] + [(400 + i, " ".join(seldom), 1) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int"))
    want = grams(" ".join(seldom)) | grams(" ".join(often))
    assert len(want) > 1 << 12 and set(np.flatnonzero(model.feature >= 0)) >= want
    one = spark.createDataFrame([(" ".join(seldom[:30]),)], "text string")
    assert toxicity.score(one, model, ["text"]).first().score >= 0.5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in op4_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert len(got) > 40 and np.mean([r.predicted == labels[r.doc_id] for r in got]) >= 0.9
