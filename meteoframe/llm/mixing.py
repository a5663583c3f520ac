"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Sources, in code point order and null last, weigh 1, 2, 3,
repeating; they share the total size by weight, no source above ``most_repeats``
times its own size, the excess being shared again.

Each source's documents are shuffled by a hash and laid end to end; the stream
is cut into blocks of ``block`` words (the last of a pass may be shorter) and
repeats as often as its target needs. The schedule is a sequence of slots: slot
i's golden-ratio point (i * phi mod 1) falls into one source's part of the
cumulative weights, and slots are ranked per source, so that any stretch of the
schedule holds the sources in proportion. A source's slot of rank k takes its
k-th block; ranks beyond its target are unused, and ranks the sequence has not
reached by its end are appended. The slot that meets the target is cut there.

Slots, blocks and documents meet in equi-joins. Starts and ranks are prefix
sums over hash ranges and slot ranges, so a source with a third of all rows is
never in one window; windows over sources see one row each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prefix_sums, staged, word_count

#: The unit interval in whole parts, and the golden ratio's fraction of them
#: (odd, so that the points of one period are all different).
PARTS = 1 << 31
GOLDEN = 1327217885
#: Equal cells of the unit interval, for joining points to sources.
CELLS = 4096


@dataclass(frozen=True)
class Settings:
    block: int = 64
    most_repeats: int = 3
    weights: tuple = (1, 2, 3)
    seed: str = "mix"
    keep_text: bool = False    # carry the texts through to the result
    slot_range: int = 65536


def sources(docs: DataFrame, settings: Settings) -> DataFrame:
    """(key, source_size, weight, target) per source of sized rows
    (key, size). Windows here see one row per source."""
    size = (docs.groupBy("key").agg(F.sum("size").alias("source_size"))
            .withColumn("place", F.row_number().over(Window.orderBy("key")) - 1))
    weight = F.element_at(F.array(*map(F.lit, settings.weights)),
                          (F.col("place") % len(settings.weights) + 1).cast("int"))
    most = F.col("source_size") * settings.most_repeats
    # water level: sources in order of most / weight; those below the level stop there
    rising = Window.orderBy(F.col("most") / F.col("weight"), "place")
    below = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    return (size.withColumn("weight", weight).withColumn("most", most)
            .withColumn("rest", F.sum("source_size").over(everything)
                        - F.sum("most").over(below) + F.col("most"))
            .withColumn("rest_weight", F.sum("weight").over(everything)
                        - F.sum("weight").over(below) + F.col("weight"))
            # the first source in that order which is not stopped sets the level for all after it
            .withColumn("free", F.col("weight") * F.col("rest") <= F.col("most") * F.col("rest_weight"))
            .withColumn("level", F.first(F.when(F.col("free"), F.struct("rest", "rest_weight")), True)
                        .over(Window.orderBy(F.col("most") / F.col("weight"), "place")
                              .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .withColumn("target", F.least(
                F.col("most").cast("double"),
                F.coalesce(F.col("weight") * F.col("level.rest").cast("double")
                           / F.col("level.rest_weight"), F.col("most").cast("double"))))
            .select("key", "source_size", "weight", "target"))


def quotas(found: DataFrame, settings: Settings) -> DataFrame:
    """Per source with words: words (its target in whole words), passes and met
    (whole passes over the source and words of the last), blocks (of a pass),
    quota (blocks taken in all)."""
    b = settings.block
    return (found.filter("source_size > 0")
            .withColumn("words", F.least(F.floor("target"), F.col("source_size") * settings.most_repeats))
            .withColumn("passes", F.expr("words div source_size"))
            .withColumn("met", F.expr("words % source_size"))
            .withColumn("blocks", F.expr(f"(source_size + {b - 1}) div {b}"))
            .withColumn("quota", F.expr(f"passes * blocks + (met + {b - 1}) div {b}")))


def schedule(quota: DataFrame, settings: Settings) -> DataFrame:
    """(slot, key, rank): the sources' turns in order, exactly ``quota`` a
    source. Slot numbers beyond the sequence are those appended."""
    spark, cell = quota.sparkSession, PARTS // CELLS
    total = quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    before = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    low = F.coalesce(F.sum("quota").over(before), F.lit(0))
    parts = (quota.select("key", (low / F.lit(total) * PARTS).cast("long").alias("low"),
                          ((low + F.col("quota")) / F.lit(total) * PARTS).cast("long").alias("high"))
             .filter("low < high").withColumn("cell", F.explode(F.expr(
                 f"sequence(low div {cell}, (high - 1) div {cell})"))))
    slots = (spark.range(total).withColumnRenamed("id", "slot")
             .withColumn("point", F.expr(f"((slot % {PARTS}) * {GOLDEN}) % {PARTS}"))
             .withColumn("cell", F.expr(f"point div {cell}"))
             .join(parts, "cell").filter("point >= low AND point < high").select("slot", "key"))
    ranked = prefix_sums(
        slots.withColumn("one", F.lit(1)).withColumn("range", F.expr(f"slot div {settings.slot_range}")),
        ["key"], [F.col("slot")], "range", "one", "rank")
    ranked = staged(ranked.select("slot", "key", F.col("rank").cast("long").alias("rank")), "mix-slots")
    reached = ranked.groupBy("key").agg(F.count("*").alias("reached"))
    missing = (quota.join(reached, "key", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))
               .filter("reached < quota").select("key", F.explode(F.expr(
                   "sequence(reached, quota - 1)")).alias("rank"))
               .select((F.lit(total) + F.col("rank")).alias("slot"), "key", "rank"))
    return (ranked.join(quota.select("key", "quota"), "key").filter("rank < quota")
            .select("slot", "key", "rank").unionByName(missing))


def plan(sized: DataFrame, settings: Settings = Settings(), found: DataFrame | None = None) -> DataFrame:
    """The mix itself, (slot, key, rank, row, low, high): at its slot a source's
    block of that rank gives words ``low`` to ``high`` of each document in it.
    Ordered by slot and ``at``, the place in the source's stream, it is the
    sequence to be trained on.

    ``sized`` has key, order, row, size; rows of size 0 never come. Ranks beyond
    a pass start the source's stream again; the last slot of a source is cut
    where the target is met.
    """
    b = settings.block
    found = found if found is not None else staged(sources(sized, settings), "mix-sources")
    quota = staged(quotas(found, settings), "mix-quotas")
    laid = prefix_sums(
        sized.filter("size > 0").withColumn("range", F.conv(F.substring("order", 1, 3), 16, 10).cast("long")),
        ["key"], [F.col("order"), F.col("row")], "range", "size", "start")
    pieces = (laid.select("key", "row", "start", (F.col("start") + F.col("size")).alias("stop"), F.explode(
        F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")).alias("block"))
        .withColumns({"at": F.greatest("start", F.col("block") * b),
                      "until": F.least("stop", (F.col("block") + 1) * b)}))
    turns = (schedule(quota, settings).join(quota.select("key", "blocks", "passes", "met"), "key")
             .withColumn("block", F.expr("rank % blocks"))
             # words of the stream that this pass takes: all but in the last one
             .withColumn("end", F.expr("CASE WHEN rank div blocks = passes THEN met END")))
    return (pieces.join(turns, ["key", "block"])
            .withColumn("until", F.least("until", F.coalesce("end", "until"))).filter("at < until")
            .select("slot", "key", "rank", "row", "at", (F.col("at") - F.col("start")).alias("low"),
                    (F.col("until") - F.col("start")).alias("high")))


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, text, any others) with size,
    source_size, target, taken: the words of the row that the mix's plan takes,
    repeats counted, at most ``most_repeats`` * size, and slot: the first that
    takes one (null if none does). Equal in every run.

    A null text has size 0; rows of size 0 are never taken. A null source is a
    source, the last. Rows equal in doc_id and text are interchangeable. Sources
    without words have target 0. An empty table gives an empty result. Columns
    named like the new ones are replaced.
    """
    new = ["size", "source_size", "target", "taken", "slot"]
    rows = docs.drop(*new)
    # sources as text that sorts as they do, the null source behind all others
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    order = F.md5(F.concat_ws("|", F.lit(settings.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                              F.coalesce("text", F.lit(""))))
    rows = staged(rows.withColumn("size", word_count(F.col("text"))).withColumn("__key", key)
                  .withColumn("__order", order).drop(*([] if settings.keep_text else ["text"]))
                  .withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    sized = rows.select(F.col("__key").alias("key"), F.col("__order").alias("order"),
                        F.col("__row").alias("row"), "size")
    found = staged(sources(sized, settings), "mix-sources")
    met = staged(plan(sized, settings, found).groupBy(F.col("row").alias("__row")).agg(
        F.sum(F.col("high") - F.col("low")).alias("taken"), F.min("slot").alias("slot")), "mix-taken")
    return (rows.join(met, "__row", "left")
            .join(found.select(F.col("key").alias("__key"), "source_size", "target"), "__key")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
            .drop("__key", "__order", "__row"))
