"""Merkle fixity audit of web archive records.

Pages become WARC response records laid end to end in page order; a record's
byte range in the archive comes from prefix sums of the record lengths. Leaves
are the records' hashes. Every ``fan`` leaves that follow each other (an ordered
offset range) make a node, whose hash covers its offsets and its children's
hashes, and so on up to one root. The tree depends on the ordered records alone.

Two replicas are compared from the top: if the roots agree, nothing else is
read; else only the children of nodes that differ are compared on each level,
down to the records that are corrupt. Levels are staged in the shared folder, a
level being ``fan`` times smaller than the one below; nodes are made by grouping
ordinals, so no task sees more than ``fan`` hashes of one node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prefix_sums, staged


@dataclass(frozen=True)
class Settings:
    fan: int = 16
    #: ranges of rows, each a window of the prefix sums; as many as shuffle
    #: partitions if None
    ranges: int | None = None


def record(url: Column, body: Column) -> Column:
    """A WARC response record as text: header, blank line, body, two line ends.
    A null url or body is empty."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def in_ranges(rows: DataFrame, order: list[Column], settings: Settings = Settings()) -> DataFrame:
    """``rows`` dealt into even ranges of their whole order, with the range's
    number: dense, sparse, repeated and null ids fill them alike."""
    dealt = rows.repartitionByRange(*([settings.ranges] if settings.ranges else []), *order)
    return dealt.withColumn("range", F.spark_partition_id())


def leaves(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(page_id, ordinal, start, length, hash) of each row's record, in order of
    page_id (null first, equal ids by hash). Only hashes and lengths are
    shuffled, never the records."""
    rows = (pages.select(F.col("page_id").cast("long"), record(F.col("url"), F.col("html")).alias("record"))
            .select("page_id", F.sha2("record", 256).alias("hash"),
                    F.octet_length("record").cast("long").alias("length"))
            .withColumn("row", F.monotonically_increasing_id()))
    order = [F.col("page_id").asc_nulls_first(), F.col("hash"), F.col("row")]
    rows = staged(in_ranges(rows, order, settings).withColumn("one", F.lit(1)), "fixity-leaves")
    rows = prefix_sums(rows, [], order, "range", "length", "start")
    rows = prefix_sums(rows, [], order, "range", "one", "ordinal")
    return rows.select("page_id", F.col("ordinal").cast("long").alias("ordinal"),
                       F.col("start").cast("long").alias("start"), "length", "hash")


def _node(start: Column, stop: Column, children: Column) -> Column:
    return F.sha2(F.concat_ws("|", start.cast("string"), stop.cast("string"), children), 256)


def tree(records: DataFrame, settings: Settings = Settings()) -> list[DataFrame]:
    """Levels from the leaves to the root: (ordinal, start, stop, hash), each
    staged. No records give one empty level."""
    level = staged(records.select("ordinal", "start", (F.col("start") + F.col("length")).alias("stop"), "hash"),
                   "fixity-level")
    levels = [level]
    while level.count() > 1:
        children = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "hash"))), lambda c: c["hash"])
        level = staged(
            level.groupBy(F.expr(f"ordinal div {settings.fan}").alias("ordinal"))
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"),
                 F.array_join(children, "").alias("children"))
            .select("ordinal", "start", "stop", _node(F.col("start"), F.col("stop"), F.col("children")).alias("hash")),
            "fixity-level")
        levels.append(level)
    return levels


def root(levels: list[DataFrame]) -> str | None:
    """The root hash; None of an empty archive."""
    top = levels[-1].first()
    return top["hash"] if top else None


def audit(ours: list[DataFrame], theirs: list[DataFrame], settings: Settings = Settings()) -> DataFrame:
    """(ordinal, start, stop) of the records that differ between two trees of
    one shape; a record that one replica lacks differs too. Replicas with trees
    of different heights are compared from the lower one's height."""
    height = min(len(ours), len(theirs))
    suspects = None
    for depth in reversed(range(height)):
        a, b = ours[depth].alias("a"), theirs[depth].alias("b")
        if suspects is not None:
            pick = F.expr(f"ordinal div {settings.fan}")
            a = ours[depth].join(suspects, pick == F.col("parent"), "left_semi").alias("a")
            b = theirs[depth].join(suspects, pick == F.col("parent"), "left_semi").alias("b")
        differ = staged(
            a.join(b, F.col("a.ordinal") == F.col("b.ordinal"), "full")
            .filter(~F.coalesce((F.col("a.hash") == F.col("b.hash")) & (F.col("a.start") == F.col("b.start"))
                                & (F.col("a.stop") == F.col("b.stop")), F.lit(False)))
            .select(F.coalesce("a.ordinal", "b.ordinal").alias("ordinal"),
                    F.coalesce("a.start", "b.start").alias("start"), F.coalesce("a.stop", "b.stop").alias("stop")),
            "fixity-differ")
        if differ.isEmpty():
            break
        suspects = differ.select(F.col("ordinal").alias("parent"))
    return differ


def audit_replica(pages: DataFrame, replica: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html, any others): page_id,
    ordinal, start, length, hash, corrupt (its record differs in ``replica``),
    root, replica_root.

    Null urls and bodies are empty; a null page_id comes first; repeated rows
    are records of their own; an empty table gives an empty result. A record
    missing from the replica, or moved there, is corrupt with all behind it.
    """
    own = staged(leaves(pages, settings), "fixity-own")
    ours, theirs = tree(own, settings), tree(leaves(replica, settings), settings)
    bad = audit(ours, theirs, settings).select("ordinal", F.lit(True).alias("bad"))
    return (own.join(bad, "ordinal", "left")
            .select("page_id", "ordinal", "start", "length", "hash",
                    F.coalesce("bad", F.lit(False)).alias("corrupt"),
                    F.lit(root(ours)).alias("root"), F.lit(root(theirs)).alias("replica_root")))


def damaged(pages: DataFrame, below: str = "03") -> DataFrame:
    """A replica with silent damage: in each row whose md5(page_id as text)
    sorts before ``below`` the first character of the body is another one."""
    hit = F.md5(F.col("page_id").cast("string")) < below
    other = F.when(F.substring("html", 1, 1) == "#", F.lit("*")).otherwise(F.lit("#"))
    return pages.withColumn("html", F.when(hit & (F.length("html") > 0), F.concat(
        other, F.expr("substring(html, 2)"))).otherwise(F.col("html")))
