"""Corpus pipeline: drop toxic and unidentifiable documents, keep one of each
near-duplicate group, mix the sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``, extra ones included and untouched whatever
their names. Each learns from and works on whatever its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteoframe.llm import langid, mixing, near_dup, pieces, toxicity
from meteoframe.llm.common import staged, table
from meteoframe.llm.queries import tokenizer_path

#: A document goes if its toxicity reaches this.
TOXIC = 0.5
#: A document goes if no language reaches this (or it has no letter).
LEAST_LANGUAGE = 0.5
#: Near copies share 80 % of their runs of five words; op7's two words would
#: also link, and drop, texts with a few spread changes.
COPIES = near_dup.Settings(shingle=5)

#: What the stages read; every other column goes along untouched.
READ = ("doc_id", "text", "lang", "source")


def hidden(docs: DataFrame):
    """``docs`` with the columns that no stage reads under neutral names, and a
    function that gives a stage's result the columns of ``docs`` back: a column
    named like one that an operator makes (score, size, copies, ...) keeps its
    values."""
    names = [c if c.lower() in READ else f"__extra_{k}" for k, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda out: out.select(*names).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labelled ones, does not
    reject. Null and empty texts have the model's base score and stay."""
    rows, shown = hidden(docs)
    model = toxicity.train(rows, table(spark, sf_dir, "labels"))
    return shown(toxicity.score(rows, model, rows.columns).filter(F.col("score") < TOXIC))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language; those without text or letters,
    or that no learned language explains better than all others, go."""
    rows, shown = hidden(docs)
    model = langid.train(rows, tokenizer_path("piece_bpe_32k.model"))
    return shown(langid.predict(rows, model, rows.columns)
                 .filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near-duplicates (rows that repeat a
    doc_id are one document). Rows without doc_id stay."""
    rows, shown = hidden(docs)
    kept = near_dup.near_duplicates(rows, COPIES).filter("kept AND doc_id IS NOT NULL").select("doc_id")
    return shown(rows.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
                 .unionByName(rows.filter("doc_id IS NULL")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them, half a document or more
    counting as one: up to three copies, none of documents left out."""
    rows, shown = hidden(docs)
    mixed = mixing.mix(rows, mixing.Settings(keep_text=True))
    copies = F.expr("(2 * taken + size) div (2 * size)")
    return shown(mixed.filter("size > 0").withColumn("copies", copies).filter("copies > 0")
                 .withColumn("copy", F.explode(F.expr("sequence(1, copies)"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (with the end id) and the hash of the decoded text
    of every document of the mix."""
    out = pieces.encode_decode(docs, tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("language_id", drop_unidentified), ("near_dedup", drop_near_copies),
          ("mixing", mix_sources), ("sentencepiece", encode)]
#: The classifiers cannot be written in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
