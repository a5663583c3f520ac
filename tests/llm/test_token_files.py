"""Token files against the tokenizer on whole texts."""

import zlib

import numpy as np
import pytest

from meteoframe.llm import token_files
from meteoframe.llm.queries import op9_token_files, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = ["", " \n\t ", "Hello, World's it's I'll 123", "a  b\tc d e", "É́ Ünïcode İstanbul ΣΑΣ",
         "<|endoftext|> x<|startoftext|>y <|", "你好 世界 \U0001f600", "é ́ x", "x" * 3000,
         "\x1c sep \x85 nel ​ zw", "ß ﬁ Ǆ", "End. END, end! end?! a.b. x's. é. É, 5. . ., <|ENDOFTEXT|>. <|endoftext|>. Don'T."]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_same_ids_as_the_tokenizer():
    coder = token_files.WordTokenizer(PATH)
    assert coder.by_word
    plain = tokenizers.Tokenizer.from_file(PATH)
    for text, got in zip(TEXTS, coder.encode([t.encode() for t in TEXTS])):
        assert np.frombuffer(got, coder.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def expected(rows, plain):
    start = 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        yield doc, start, len(ids), crc(ids)
        start += len(ids)


def test_edge_rows_and_random_access(spark, tmp_path):
    plain = tokenizers.Tokenizer.from_file(PATH)
    rows = [(5, None), (3, ""), (None, "null id"), (9, "long " * 20000), (9, "b"), (9, "b"),
            *[(20 + i, t) for i, t in enumerate(TEXTS)]]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, start string")
    folder = f"file://{tmp_path}/out"
    manifest = token_files.write_token_files(df, folder, PATH, shards=3)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32)
                  for r in token_files.read_token_files(manifest, folder).collect()), key=lambda r: r[1])
    assert got == list(expected(rows, plain))
    assert len(token_files.document_ids(folder, 0, 0)) == got[0][2]
    empty = token_files.write_token_files(df.limit(0), f"{tmp_path}/none", PATH, shards=2)
    assert token_files.read_token_files(empty, f"{tmp_path}/none").count() == 0


def test_query_matches_brute_force(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.001"
    plain = tokenizers.Tokenizer.from_file(PATH)
    rows = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    got = sorted(tuple(r) for r in op9_token_files(spark, sf).select(
        "doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == sorted(expected(rows, plain))


def test_words_of_letters_are_told_apart_without_offsets(monkeypatch):
    """Their ids are the tokenizer's own; only other words ask for offsets."""
    import random
    rng = random.Random(9)
    words = ["".join(rng.choices("aeinorstXQz", k=rng.randrange(1, 14))) for _ in range(700)] + ["don't", "x1", "ünd", "re"]
    coder, asked = token_files.WordTokenizer(PATH), []
    slow = coder._by_offsets
    monkeypatch.setattr(coder, "_by_offsets", lambda own: asked.extend(own) or slow(own))
    plain = tokenizers.Tokenizer.from_file(PATH)
    got = coder.encode([" ".join(words).encode()])[0]
    assert np.frombuffer(got, coder.dtype).tolist() == plain.encode(" ".join(words), add_special_tokens=False).ids
    assert sorted(asked) == sorted(w.encode() for w in ["don't", "x1", "ünd"])
