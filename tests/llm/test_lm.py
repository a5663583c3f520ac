"""Language model: counts, normalisation, training, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyspark.sql.functions as F

from meteoframe.llm import lm
from meteoframe.llm.queries import op1_lm_scoring

SMALL = lm.Settings(words=12, tails=5, known=20, size=4, noise=8, batch=64, stride=1, slices=3)


def base_scores(rows, held):
    """{row: (n_tokens, n_known, N, base)} by counting."""
    tokens = [((t or "").encode().lower().split() + [None]) for _, t in rows]
    counts = Counter()
    for i, own in enumerate(tokens):
        if not held(rows[i][0]):
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    return [(len(own), sum(counts[w] > 0 for w in own), n,
             sum(math.log10((counts[w] + 1) / (n + (v + 1))) for w in own)) for own in tokens]


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


ROWS = [(i, " ".join(f"w{(i * k) % 31}" for k in range(1, 30))) for i in range(40)]
ROWS += [(100, None), (101, ""), (102, "W1 w1\tW1"), (103, "never seen words"), (None, "w1 w2"), (104, "w3 " * 200_000),
         (105, "dup"), (105, "dup")]


def held(doc):
    return doc is not None and doc % 5 == 3


def test_counts_and_base_scores(spark):
    df = spark.createDataFrame([(d, t, 0.0) for d, t in ROWS], "doc_id long, text string, score double")
    flag = F.coalesce(F.col("doc_id") % 5 == 3, F.lit(False))
    for settings in (SMALL, lm.Settings(known=0, words=3, tails=2, stride=2, size=2)):
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                     for r in lm.score_texts(df, flag, settings).collect())
        want = sorted((str(d), held(d), *b) for (d, _), b in zip(ROWS, base_scores(ROWS, held)))
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[:5] == w[:5] and close(g[5], w[5]), (g, w)
    assert lm.score_texts(df.limit(0), flag, SMALL).count() == 0
    none = lm.score_texts(df, F.lit(True), SMALL).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in none)


def test_probabilities_are_normalised(spark):
    """Of every context over all outputs, and of the words of a class."""
    rng = np.random.default_rng(0)
    m = lm.Model.start(np.full(SMALL.outputs, 1 / SMALL.outputs), SMALL)
    m.vectors[:] = rng.normal(0, 1, m.vectors.shape)
    m.places[1] = 0.5
    logs = lm.normalisers(spark, m, SMALL)
    for context in [(3, 4), (0, 7), (17, 17)]:
        texts = [np.array([*context, w, lm.END], np.uint16) for w in range(SMALL.outputs)]
        p = [lm.log_probabilities(m, logs, [t])[2] for t in texts]
        assert math.isclose(np.exp(p).sum(), 1, rel_tol=1e-4)
    one = lm.log_probabilities(m, logs, [np.array([5, 6, 0], np.uint16)])
    both = lm.log_probabilities(m, logs, [np.array([9, 0], np.uint16), np.array([5, 6, 0], np.uint16)])
    assert np.allclose(one, both[2:])                                 # no context from the text before


def test_training_learns_successors():
    rng = np.random.default_rng(1)
    s = lm.Settings(words=12, tails=5, size=8, noise=16, batch=256, rate=0.1)
    unigram = np.full(s.outputs, 1 / s.outputs)
    trainer = lm.Trainer(lm.Model.start(unigram, s), unigram, s, 0)
    for _ in range(400):
        last, before = rng.integers(0, s.outputs, (2, 256))
        trainer.batch(last, before, (last + 1) % s.outputs)
    m = trainer.model
    score = (m.vectors * m.places[0]) @ m.targets.T + m.bias
    assert (score.argmax(axis=1) == (np.arange(s.outputs) + 1) % s.outputs).mean() > 0.9


def test_rounds_train_on_every_position(spark):
    rng = np.random.default_rng(2)
    for s in (lm.Settings(words=12, tails=5, size=4), lm.Settings(words=12, tails=5, size=4, stride=3, rounds=1)):
        texts = [np.append(rng.integers(1, s.outputs, n), lm.END).astype(np.uint16) for n in (0, 1, 6, 50, 333, 20)]
        total = sum(map(len, texts))
        rounds = max(s.rounds, s.stride)
        seen = np.sort(np.concatenate([lm._turn(texts, k, s.stride) for k in range(s.stride)]))
        assert (seen == np.arange(total)).all()
        unigram = np.full(s.outputs, 1 / s.outputs)
        sent = spark.sparkContext.broadcast((lm.Model.start(unigram, s).flat(), unigram))
        df = spark.createDataFrame([(t.tobytes(),) for t in texts], "ids binary").repartition(2)
        got = sum(r["seen"] for k in range(rounds) for r in df.mapInArrow(
            lm._trainer(sent, s, k), "slice int, seen long, part binary").filter("slice = 0").collect())
        assert got == total


def test_query_beats_unigrams_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    mod = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    want = {d: b for (d, _), b in zip(rows, base_scores(rows, mod))}
    got = op1_lm_scoring(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == mod(r.doc_id)
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3] and close(r.base_score, want[r.doc_id][3])
    kept = [r for r in got if r.held_out]
    assert sum(r.score for r in kept) > sum(r.base_score for r in kept)
