"""Byte-level BPE against the tiktoken library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from meteoframe.llm import byte_pairs
from meteoframe.llm.queries import op12_byte_pairs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_pairs.read_ranks(PATH),
                             special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_pairs.BytePairs(byte_pairs.read_ranks(PATH), public_tokenizers.PATTERN)


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def odd_texts():
    rng = random.Random(2)
    texts = ["", " ", "  ", "a", "it's they'LL we'd", "x" * 3000, "ab" * 700, "\n\n\n  \t x", "日本語" * 200, "é" * 90,
             "🙂🙂🏽 zwj 👩‍👩‍👧", "١٢٣ 4½ ²", "<|endoftext|>", "\x00\x1c\x1d\x85\xa0 ᠎﻿", "=" * 400,
             "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5000)), "".join(rng.choices("aAbB", k=1500)),
             "".join(rng.choices("ACGT", k=4000)), " " * 700 + "end", "а" * 500]
    return texts + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000), rng.randrange(0xE000, 0x20000)]))
                            for _ in range(rng.randrange(60))) for _ in range(300)]


def test_odd_texts(codec, library):
    texts = odd_texts()
    for text, packed in zip(texts, codec.encode(texts)):
        assert ids_of(packed) == library.encode_ordinary(text), text[:40]
        assert codec.decode(packed) == text.encode()


def test_every_character(codec, library):
    """The pattern's classes agree with the library's for every code point."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 16):
        text = "".join(f"x{chr(c)}y {chr(c)}" for c in points[at:at + (1 << 16)])
        assert ids_of(codec.encode([text])[0]) == library.encode_ordinary(text), hex(points[at])


def test_long_matches_merge_alike(codec):
    """Merging all places of the least rank gives what one at a time gives."""
    rng = random.Random(4)
    for letters in ("ab", "aeiou", "abcdefghijklmnopqrstuvwxyz", "=-", "あいう"):
        for n in (2, 3, 50, 200):
            word = "".join(rng.choices(letters, k=n)).encode()
            one = codec.merge([word], byte_pairs._bucket(len(word)))[0]
            assert codec.merge_long(word).tolist() == ids_of(one)


def test_made_up_ranks_keep_the_order():
    """Ranks for which merging a place lowers the least rank beside it."""
    ranks = {bytes([b]): 300 + b for b in range(256)}
    ranks |= {b"ab": 20, b"abc": 5, b"cab": 3, b"ababc": 1, b"aba": 7, b"bab": 6, b"caba": 2, b"bc": 30}
    codec = byte_pairs.BytePairs(ranks, r".+")
    library = tiktoken.Encoding("odd", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices("abc", k=rng.randrange(1, 90)))
        assert ids_of(codec.encode([text])[0]) == library.encode_ordinary(text)
        if text.encode() not in ranks:
            assert codec.merge_long(text.encode()).tolist() == library.encode_ordinary(text)


def test_pair_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1000, (5000, 2)), axis=0)
    table = byte_pairs.PairTable(keys[:, 0], keys[:, 1], np.arange(len(keys), dtype=np.int32))
    assert (table(keys[:, 0], keys[:, 1]) == np.arange(len(keys))).all()
    assert (table(keys[:, 0] + 1000, keys[:, 1]) == byte_pairs.NO_RANK).all()
    assert (table(np.array([[-1]]), np.array([[3]])) == byte_pairs.NO_RANK).all()


def test_query_is_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op12_byte_pairs(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest()


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "no id", "a"), (3, "same", "a"), (3, "same", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = byte_pairs.encode_decode(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in got) == [(0, b"no id"), (1, b""), (2, b""), (3, b"same"), (3, b"same")]
    assert {len(r.ids) for r in got if r.doc_id in (1, 2)} == {0}
    assert byte_pairs.encode_decode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
