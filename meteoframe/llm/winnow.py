"""Document fingerprints by winnowing, in DataFrame functions only.

A lower-cased text's tokens are its runs of non-space characters, cut in parts
of at most ``part`` characters. A run of more than ``word`` characters is no word
(a text without spaces, an encoded string): it has a token of ``part`` characters
from every character on, so that a passage has the same tokens wherever in such
runs it stands. Every ``gram`` consecutive tokens give a rolling 32-bit hash; in every window of
``window`` consecutive hashes the smallest is chosen, the rightmost of equal
ones, and kept with its token position. Texts that share ``gram + window - 1``
consecutive tokens therefore share a fingerprint, wherever it stands. A text
with fewer tokens than a gram has one hash of them all, one with fewer hashes
than a window has one choice; a text without tokens has none.

A hash and its position are one number, hash above and distance from the end of
the position range below, so that the smallest number is the smallest hash with
the largest position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS

#: Positions of any text fit below this (a Java string's length does).
POSITIONS = 1 << 31


@dataclass(frozen=True)
class Settings:
    gram: int = 4
    window: int = 4
    part: int = 8
    word: int = 32
    #: ids that share a window of the neighbour search
    id_range: int = 1024


def _let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(items: Column, width: int, body) -> Column:
    """``body(i)`` for the 0-based start of every run of ``width`` items, or
    once for all of fewer; empty for none."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - width, F.lit(0)))
    return F.when(F.size(items) > 0, F.transform(starts, body)).otherwise(
        F.array().cast("array<bigint>"))


def tokens(text: Column, settings: Settings) -> Column:
    """The tokens of a lower-cased text. Only texts with a run that is no word
    are looked at again."""
    part, longer = rf"[^{SPACE_CLASS}]{{1,{settings.part}}}", rf"[^{SPACE_CLASS}]{{{settings.word + 1}"
    runs = F.regexp_extract_all(text, F.lit(rf"{longer},}}+|{part}"), F.lit(0))
    slid = F.flatten(F.transform(runs, lambda r: F.when(
        F.length(r) > settings.part, F.regexp_extract_all(r, F.lit(rf"(?s)(?=(.{{{settings.part}}}))."), F.lit(1)))
        .otherwise(F.array(r))))
    return F.when(F.regexp_like(text, F.lit(longer + "}")), slid).otherwise(
        F.regexp_extract_all(text, F.lit(part), F.lit(0)))


def chosen(text: Column, settings: Settings = Settings()) -> Column:
    """Array of the numbers (hash, position) chosen from ``text``, in order."""
    hashes = F.transform(tokens(F.lower(text), settings), lambda t: F.xxhash64(t))

    def grams(h):
        return _runs(h, settings.gram, lambda i: (
            F.shiftleft(F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + k) for k in range(settings.gram)]), 32), 31)
            + (POSITIONS - 1) - i))

    def least(g):
        return F.array_distinct(_runs(g, settings.window, lambda i: F.least(
            *[F.get(g, i + k) for k in range(settings.window)])))

    return _let(_let(hashes, grams), least)


def hashes_of(numbers: Column) -> Column:
    """The distinct hashes among chosen numbers."""
    return F.array_distinct(F.transform(numbers, lambda v: F.shiftright(v, 31)))


def as_text(numbers: Column) -> Column:
    """``hash@position`` for each choice, hashes in hexadecimal."""
    return F.array_join(F.transform(numbers, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, 31))), F.lit("@"),
        (F.lit(POSITIONS - 1) - v.bitwiseAND(F.lit(POSITIONS - 1))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared over all hashes of two sets; 1 for two empty sets."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _with_carried(docs: DataFrame, settings: Settings) -> DataFrame:
    """Rows with the id range ``part`` they are looked at in, and once more,
    marked ``carried``, the first row of each range at the end of the range
    before it (in descending order; the very first at the end of the last). The
    ranges are ordered on two levels, so no task sees them all."""
    ranged = docs.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn(
        "part", F.floor(F.col("place") / settings.id_range))
    heads = ranged.groupBy("part").agg(F.max("place").alias("head")).withColumn(
        "group", F.floor(F.col("part") / settings.id_range))
    tops = heads.groupBy("group").agg(F.min("part").alias("low"), F.max(F.struct("part", "head")).alias("top"))
    down = Window.orderBy(F.desc("group"))
    ends = (tops.withColumn("to", F.coalesce(F.lag("low").over(down), F.last("low").over(
                down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
            .select(F.col("top.head").alias("head"), "to"))
    inner = (heads.withColumn("to", F.lag("part").over(Window.partitionBy("group").orderBy(F.desc("part"))))
             .filter("to IS NOT NULL").select("head", "to"))
    carry = inner.unionByName(ends)
    return (ranged.join(carry, F.col("place") == F.col("head"), "left")
            .withColumn("at", F.explode(F.when(F.col("to").isNull(), F.array(F.struct(
                F.col("part"), F.lit(False).alias("carried")))).otherwise(F.array(
                    F.struct(F.col("part"), F.lit(False).alias("carried")),
                    F.struct(F.col("to").alias("part"), F.lit(True).alias("carried"))))))
            .select("doc_id", "text", "place", "at.part", "at.carried"))


def fingerprint_edits(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row of ``docs`` (doc_id, text, any others).

    The edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next row's text, in descending doc_id (null
    last, equal ids by text); after the last row comes the first. A null text is
    empty; an empty text has an empty fingerprint, and two of them likeness 1.
    An empty table gives an empty result. Texts are shuffled once.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("part").orderBy("carried", F.desc("place"), "text")
    # the texts are dealt out before they are fingerprinted: the window needs no
    # further shuffle and fingerprints never travel
    rows = (_with_carried(rows, settings).repartition("part")
            .withColumn("own", chosen(F.col("text"), settings))
            .withColumn("own_set", hashes_of(F.col("own")))
            .withColumn("next", F.lead("text").over(order))
            .withColumn("next_set", F.lead("own_set").over(order))
            .filter("NOT carried")
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(
                F.expr("substring(text, 1, cast(n_chars - n_chars div 3 as int))"),
                F.expr("substring(next, 1, cast(n_chars div 3 as int))")))
            .withColumn("other", chosen(F.col("edited"), settings)))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own_set"), hashes_of(F.col("other"))).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_set")).alias("near_next"))
