"""Winnowing against a brute-force version."""

import hashlib
import re

import xxhash

from meteoframe.llm import winnow
from meteoframe.llm.queries import op3_winnowing

S = winnow.Settings()


def signed_hash(values, seed=42):
    for v in values:
        seed = xxhash.xxh64(v if isinstance(v, bytes) else (v % (1 << 64)).to_bytes(8, "little"), seed).intdigest()
    return seed


def brute(text):
    """[(hash, position)] by looking at every window."""
    tokens = []
    for run in re.findall(r"[^\x20\x09-\x0D]+", text.lower()):
        tokens += ([run[i:i + S.part] for i in range(len(run) - S.part + 1)] if len(run) > S.word
                   else [run[i:i + S.part] for i in range(0, len(run), S.part)])
    h = [signed_hash([t.encode()]) for t in tokens]
    if not h:
        return []
    grams = [signed_hash(h[i:i + S.gram]) >> 32 for i in range(max(len(h) - S.gram, 0) + 1)]
    out = []
    for i in range(max(len(grams) - S.window, 0) + 1):
        window = grams[i:i + S.window]
        at = max(k for k, g in enumerate(window) if g == min(window)) + i
        if (grams[at], at) not in out:
            out.append((grams[at], at))
    return out


def as_text(chosen):
    return " ".join(f"{h:x}@{p}" for h, p in chosen)


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1]))
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        a, b, c = brute(text), brute(edited), brute(after)
        yield (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(a), as_text(b),
               likeness(a, b), likeness(a, c))


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    words = " ".join(f"w{i % 7}" for i in range(60))                  # many equal hashes: ties
    rows = [(5000, words), (4999, ""), (3, None), (2, "one"), (2, "two words"), (2, "two words"), (None, "null id"),
            (1_000_000, "x" * 5000), (999_999, "日本語のテキスト" * 50), (-7, "\U0001f600 " * 40), (1024, "a b c d e")]
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, next string")
    assert collected(winnow.fingerprint_edits(df)) == sorted(expected(rows), key=repr)
    assert winnow.fingerprint_edits(df.limit(0)).count() == 0
    one = collected(winnow.fingerprint_edits(df.filter("doc_id = 5000")))
    assert one == list(expected([(5000, words)]))


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = collected(op3_winnowing(spark, sf))
    assert got == sorted(expected(rows), key=repr)
    by = {}
    for g in got:
        by.setdefault(g[3], []).append(g)
    assert sum(g[5] > g[6] for g in got) > 0.9 * len(got)


def test_unspaced_passages_match_wherever_they_stand(spark):
    """A passage without spaces after one to nine other characters."""
    import random
    rng = random.Random(9)
    passage = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    odd = "".join(chr(0x1F600 + rng.randrange(60)) for _ in range(100)) + "".join(rng.choices("abcXYZ0189+/", k=200))
    rows = [(100 - k, "".join(chr(0x3041 + rng.randrange(80)) for _ in range(k)) + p)
            for p, at in ((passage, 0), (odd, 50)) for k in range(at and 1, 10)]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in winnow.fingerprint_edits(df).collect()}
    for d, t in rows:
        assert got[d].fingerprint == as_text(brute(t))
    shared = [r.near_next for d, r in got.items() if d not in (0, 10)]
    assert min(shared) > 0.8


def test_runs_about_the_length_of_a_word(spark):
    rows = [(n, "x y " + "".join(chr(97 + i * 7 % 26) for i in range(n)) + " z") for n in range(28, 40)]
    got = winnow.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {d: as_text(brute(t)) for d, t in rows}
