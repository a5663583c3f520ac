"""Registered queries of the training-data operators (one per operator, over
its whole table) and the DuckDB statements where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, join_path
from . import (ann, byte_pairs, filter_audit, fixity, langid, lm, mixing, near_dup, pieces, sql, token_files,
               toxicity, vector_codes, winnow)
from .common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (outside the repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


@register("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register("op3_winnowing")
def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_edits(table(spark, sf_dir, "documents"))


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    model = toxicity.train(docs.filter("NOT held_out"), table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model, ["doc_id", "held_out"])
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


@register("op5_fixity_audit", sql.FIXITY)
def op5_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return fixity.audit_replica(pages, fixity.damaged(pages))


@register("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode_decode(table(spark, sf_dir, "documents"),
                               tokenizer_path("piece_bpe_32k.model"))
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "spans_sha256",
        # where the alignment puts the end of the last piece before the end id
        F.expr("CASE WHEN size(ends) > 1 THEN element_at(ends, -2) ELSE 0 END").cast("long").alias("n_bytes"))


@register("op7_near_duplicates", sql.NEAR_DUPLICATES)
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@register("op8_mixing", sql.MIXING)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "slot")


@register("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = join_path(checkpoint_dir(spark), f"token-files-{uuid.uuid4().hex}")
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(manifest, folder)


@register("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 4, 2))
    model = langid.train(docs.filter("NOT held_out"), tokenizer_path("piece_bpe_32k.model"))
    return langid.predict(docs, model, ["doc_id", "held_out"])


@register("op11_filter_audit", sql.FILTER_AUDIT)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("filter")


@register("op12_byte_pairs")
def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = byte_pairs.encode_decode(table(spark, sf_dir, "documents"),
                                   tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", F.expr("CAST(octet_length(ids) AS BIGINT) div 4").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op13_vector_codes", sql.VECTOR_CODES)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")
