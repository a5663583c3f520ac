"""Language identification: sums over segmentations, training, held-out accuracy."""

import itertools
import re
import zlib

import numpy as np
import pytest

from meteoframe.llm import langid
from meteoframe.llm.queries import op10_language_id, tokenizer_path

pytest.importorskip("sentencepiece")
PATH = tokenizer_path("piece_bpe_32k.model")
WORDS = ["▁the", "▁ab", "▁über", "▁naïve", "▁日本", "▁x", "▁\U0001f600a", "▁onthe"]


def segmentations(word, vocabulary):
    """All ways to spell ``word``: lists of piece ids."""
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate([*cuts, 1]):
            if c:
                parts.append(word[at:i + 1])
                at = i + 1
        ids = []
        for part in parts:
            if part in vocabulary.ids:
                ids.append(vocabulary.ids[part])
            elif len(part) == 1:
                ids += [int(vocabulary.byte[b]) for b in part.encode()]
            else:
                break
        else:
            yield ids


def test_forward_sums_all_segmentations():
    vocabulary = langid.Vocabulary(PATH)
    rng = np.random.default_rng(0)
    p = rng.random((vocabulary.size + 1, 3)) * 0.1
    p[-1] = 0
    got = langid.word_logs(vocabulary, p, WORDS)
    for word, logs in zip(WORDS, got):
        brute = sum(p[ids].prod(axis=0) for ids in segmentations(word, vocabulary))
        assert np.allclose(np.exp(logs), brute, rtol=1e-9), word


def test_expected_counts():
    vocabulary = langid.Vocabulary(PATH)
    p = np.random.default_rng(1).random((vocabulary.size + 1, 2)) * 0.1
    p[-1] = 0
    words = ["▁über", "▁onto"]
    counts = np.array([[2.0, 1.0], [0.0, 3.0]])
    got = langid.Lattice(vocabulary, words).expected(p, counts)
    want = np.zeros_like(p)
    for word, n in zip(words, counts):
        ways = list(segmentations(word, vocabulary))
        total = sum(p[w].prod(axis=0) for w in ways)
        for w in ways:
            for i in w:
                want[i] += n * p[w].prod(axis=0) / total
    assert np.allclose(got, want)


def plain_arcs(word, vocabulary):
    """(start, end, piece ids) of every piece in ``word``, by looking them up."""
    for i in range(len(word)):
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in vocabulary.ids:
                yield i, j, [vocabulary.ids[word[i:j]]]
            elif j == i + 1:
                yield i, j, [int(vocabulary.byte[b]) for b in word[i].encode()]


def plain_sums(word, logp, vocabulary):
    """Forward and backward sums in logarithms for one language, one by one."""
    ways = list(plain_arcs(word, vocabulary))
    alpha, beta = np.full(len(word) + 1, -np.inf), np.full(len(word) + 1, -np.inf)
    alpha[0] = beta[-1] = 0.0
    for i, j, ids in sorted(ways):
        alpha[j] = np.logaddexp(alpha[j], alpha[i] + logp[ids].sum())
    for i, j, ids in sorted(ways, reverse=True):
        beta[i] = np.logaddexp(beta[i], beta[j] + logp[ids].sum())
    return ways, alpha, beta


LONG_RUNS = ["日本語中文" * 13, "thequickbrown" * 6, "ſßé𐐀" * 20, "ab" * 35, "x" * 70]


def test_sums_of_all_lengths_and_small_weights():
    """Lengths 60 to 70 and 1 to 5, pieces so rare that no plain product holds them."""
    vocabulary = langid.Vocabulary(PATH)
    p = 10.0 ** np.random.default_rng(2).uniform(-12, -1, (vocabulary.size + 1, 2))
    p[-1] = 0
    words = ["▁" + run[:n] for run in LONG_RUNS for n in [1, 2, 5, *range(60, 71)]]
    got = langid.word_logs(vocabulary, p, words)
    logp = np.log(p[:-1])
    for word, logs in zip(words, got):
        want = [plain_sums(word, logp[:, k], vocabulary)[1][-1] for k in range(2)]
        assert np.allclose(logs, want, rtol=1e-9), word
    for word in ["▁" + run[:63] for run in LONG_RUNS]:
        uses = langid.Lattice(vocabulary, [word]).expected(p, np.array([[1.0, 3.0]]))
        want = np.zeros_like(p)
        for k in range(2):
            ways, alpha, beta = plain_sums(word, logp[:, k], vocabulary)
            for i, j, ids in ways:
                for piece in ids:
                    want[piece, k] += (1, 3)[k] * np.exp(alpha[i] + beta[j] + logp[ids, k].sum() - alpha[-1])
        assert np.allclose(uses, want, rtol=1e-6, atol=1e-12), word


def plain_model(rows, vocabulary, rounds=2, smoothing=0.02):
    """Training and prediction in plain Python: {lang: (log prior, log piece weights)}."""
    words = [[r[k:k + 63] for r in re.findall(r"[^\W\d_]+", (t or "").lower()) for k in range(0, len(r), 63)]
             for t, _ in rows]
    langs = sorted({lang for w, (t, lang) in zip(words, rows) if w and lang is not None})
    own = {lang: [x for w, (t, of) in zip(words, rows) if of == lang for x in w] for lang in langs}
    total = sum(map(len, own.values()))
    model = {}
    for lang in langs:
        p = np.full(vocabulary.size, 1 / vocabulary.size)
        for _ in range(rounds):
            uses = np.full(vocabulary.size, smoothing)
            for word in own[lang]:
                ways, alpha, beta = plain_sums("▁" + word, np.log(p), vocabulary)
                for i, j, ids in ways:
                    for piece in ids:
                        uses[piece] += np.exp(alpha[i] + beta[j] + np.log(p[ids]).sum() - alpha[-1])
            p = uses / uses.sum()
        model[lang] = np.log(len(own[lang]) / total), np.log(p)
    logs = [[prior + sum(plain_sums("▁" + x, logp, vocabulary)[1][-1] for x in w) for prior, logp in model.values()]
            for w in words]
    return langs, words, np.array(logs)


def test_query_equals_plain_python(spark, tmp_path):
    """The registered query on a small table, every row's language and score."""
    texts = [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the hund", None), ("die cat", None),
             ("日本語中文" * 14, "ja"), ("日本語", "en"), ("thequickbrown" * 6, "en"), ("derhundunddie" * 6, "de"),
             ("Über the naïve", "de"), ("", "en"), (None, "de"), ("42 !", "ja"), ("the the the", "de"), ("katze", "de"),
             ("cat", "en"), ("und", "en"), ("ſßé𐐀" * 20, "de"), ("dog katze", None), ("日本 the", None), ("hund", "de")]
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int").coalesce(2).write.parquet(
        str(tmp_path / "documents.parquet"))
    vocabulary = langid.Vocabulary(PATH)
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(len(texts))]
    langs, words, logs = plain_model([(t, None if h else lang) for (t, lang), h in zip(texts, held)], vocabulary)
    got = {r.doc_id: r for r in op10_language_id(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, own in enumerate(words):
        r = got[i]
        assert r.held_out == held[i]
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        odds = np.exp(logs[i] - logs[i].max())
        assert r.lang_pred == langs[int(logs[i].argmax())], i
        assert abs(r.score - 1 / odds.sum()) < 2e-3, i


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog " * 50, "en", 1), (2, "der hund und die katze " * 50, "de", 2), (3, None, "en", 3),
            (4, "", "de", 4), (5, "12 .. !", "en", 5), (6, "hund " * 30000, None, 6), (None, "the dog", "en", 7),
            (7, "日本" * 300, "en", 8), (7, "the", "en", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = langid.train(df, PATH)
    assert model.languages == ["de", "en"]
    got = {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(df, model, ["doc_id"]).collect()}
    by = {(d, l) for d, l, _ in got}
    assert {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de"), (None, "en")} <= by
    assert all(0 <= s <= 1 for _, _, s in got)
    assert langid.train(df.limit(0), PATH) is None
    none = langid.predict(df, None, ["doc_id"]).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == len(rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.001"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op10_language_id(spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and held
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
