"""SentencePiece codec against the library on whole texts."""

import hashlib

import numpy as np
import pytest

from meteoframe.llm import pieces
from meteoframe.llm.queries import op6_sentencepiece, tokenizer_path

sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizer_path("piece_bpe_32k.model")
TEXTS = ["", " ", "   ", "a", "Hello world", " lead and trail ", "two  spaces   three", "line\nbreak\ttab",
         "naïve über été", "▁mark ▁▁x", "你好 \U0001f600 \u0000 nul",
         "<s> </s> <unk> <0x41>", "x" * 5000, ("word " * 3000) + "  end"]


def test_same_ids_and_spans_as_the_library():
    codec = pieces.Codec(PATH)
    assert codec.by_chunk
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text, (ids, bounds) in zip(TEXTS, codec.encode([t.encode() for t in TEXTS])):
        assert ids.tolist() == model.encode(text), text
        raw = text.encode()
        assert bounds[0] == 0 or not len(ids)
        assert (np.diff(bounds) >= 0).all() and (not len(ids) or bounds[-1] == len(raw))
        made = model.encode(text, return_type="proto").pieces
        assert bounds.tolist() == [p.begin for p in made] + [made[-1].end if made else 0], text
        whole = codec._whole(raw)
        assert whole[0].tolist() == ids.tolist() and whole[1].tolist() == bounds.tolist()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_compiled_map_agrees_with_the_library(rule):
    norm = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True,
                                                 escape_whitespaces=True, remove_extra_whitespaces=True)
    own = pieces.Normaliser(norm.serialized_model_proto())
    for text in [*TEXTS[1:], "ＡＢ ﬁ ①   é 　 x"]:
        got, source = own(text.encode())
        assert got.decode() == norm.normalize(text), (rule, text)
        assert len(source) == len(got) + 1 and (np.diff(source) >= 0).all()


def test_edge_rows(spark):
    rows = [(1, None, "z"), (2, "", "z"), (None, "a b", "z"), (3, "x " * 50000, None), (3, "a", "z"), (3, "a", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = pieces.encode_decode(df, PATH).collect()
    assert len(got) == 6
    by = {(r.doc_id, r.decoded[:3]): r for r in got}
    assert by[(1, "")].ids == [2] and by[(2, "")].ids == [2]
    assert by[(None, "a b")].ends[-1] == 3
    assert pieces.encode_decode(df.limit(0), PATH).count() == 0


def test_query_matches_brute_force(spark):
    import pyarrow.parquet as pq
    sf = "/root/testdata/sf0.001"
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    got = {r.doc_id: r for r in op6_sentencepiece(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = model.encode(d["text"] or "") + [2]
        r = got[d["doc_id"]]
        made = model.encode(d["text"] or "", return_type="proto").pieces
        bounds = [p.begin for p in made] + [made[-1].end if made else 0]
        assert r.n_tokens == len(ids) and r.n_bytes == bounds[-1]
        assert r.spans_sha256 == hashlib.sha256(np.array(bounds, "<u4").tobytes()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
