"""Mixing sources to target weights by a time-varying curriculum.

Each source gets a target of words: the budget is shared by weight, no target exceeds
``max_epochs`` times the source, and what is cut off there is shared anew by weight. A
source's schedule says how its demand is spread over the training, from 0 to 1: a rate that
changes linearly, ``1 - slope`` at the start and ``1 + slope`` at the end. Its integral is the
cumulative demand. The source's documents stand in a fixed pseudo-random order, as often as
needed; the document before which c words have been demanded has the position at which the
cumulative demand reaches c. Sorting all documents of all sources by position gives the
training order.

Sums inside a source are taken in two steps, over hash ranges of the documents and inside each
range, so a source with most of the rows is spread like any other.

Defined cases: null texts have no words; documents without source form the last source;
sources without words have target 0; documents without id and repeated rows count like others
(repeated rows follow each other); equal positions go by a hash; a text of any length is counted whole; no rows
give no rows; other columns are kept, whatever their names, but for those named like the ones added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perkline.llm.names import unused
from perkline.llm.ordering import numbered
from perkline.llm.storage import stored

WEIGHTS = (5.0, 2.0, 1.0)
SLOPES = (0.5, 0.0, -0.5)  # heavy sources come rather late, light ones early
RANGES = 1024
WORD = r"[^\x20\x09-\x0D]+"
NO_SOURCE = "no source"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    slopes: tuple[float, ...] = SLOPES,
    share: float = 1.5,
    max_epochs: float = 2.0,
) -> DataFrame:
    """Adds rank, weight, slope and target to one row per source (source, source_size).

    A table of sources, not of documents: its windows run over all sources.
    """
    n = len(weights)
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    )
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("rank") % n)
    ranked = ranked.withColumn("weight", pick(weights)).withColumn("slope", pick(slopes))
    # Sources in the order in which they reach their limit as the level rises.
    ranked = ranked.withColumn("limit", F.col("source_size") * max_epochs)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * share
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    ranked = ranked.withColumn("level", level)
    free = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    ranked = ranked.withColumn("level", F.first(free, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return ranked.select("source", "source_size", "rank", "weight", "slope", target.alias("target"))


def _position(demanded: Column, target: Column, slope: Column) -> Column:
    """Where the cumulative demand ``target * (t + slope * (t * t - t))`` reaches ``demanded``; slope below 1."""
    part = F.least(F.lit(1.0), F.coalesce(F.try_divide(demanded, target), F.lit(0.0)))
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * part)
    # 2c / (b + root) is the usual formula without a division by a slope of zero.
    return F.least(F.lit(1.0), 2 * part / (1 - slope + root))


def curriculum(docs: DataFrame, max_epochs: int = 2, whole: bool = False, **targets) -> DataFrame:
    """``docs`` with size, source_size, target, and ``takes``: an array of (epoch, words, position).

    By default the last document of a source's demand is cut, so that the words taken are the
    target to the word. With ``whole`` it is taken whole if at least half of it is wanted.
    """
    added = ("size", "source_size", "target", "takes")
    docs = docs.drop(*added)
    order_, range_, start, named_, inside_, from_, target_slope = unused(
        docs.columns, "_order", "_range", "_start", "_source", "_inside", "_from", "slope"
    )
    size = word_count(F.col("text"))
    order = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    spread = F.pmod(order, F.lit(RANGES)).cast("int")
    sized = docs.withColumns({"size": size, order_: order, range_: spread})

    ranges = stored(
        sized.groupBy("source", range_).agg(F.sum("size").alias("words")), "mixing-ranges"
    )
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = source_targets(sizes, max_epochs=float(max_epochs), **targets).drop("rank", "weight").withColumnRenamed("slope", target_slope)
    ahead = Window.partitionBy("source").orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn(start, F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    named = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    starts = starts.withColumn(named_, named).drop("source").join(
        plan.withColumn(named_, named).drop("source"), named_
    )

    inside = (
        Window.partitionBy(named_, range_)
        .orderBy(order_, "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        sized.withColumn(named_, named)
        .withColumn(inside_, F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, [named_, range_])
        .withColumn(from_, F.col(start) + F.col(inside_))
    )
    wanted = F.round("target").cast("long")

    def take(epoch: int) -> Column:
        begin = F.col(from_) + F.col("source_size") * epoch
        left = wanted - begin
        if whole:
            words = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(F.lit(0))
        else:
            words = F.greatest(F.lit(0), F.least(F.col("size"), left))
        return F.struct(
            F.lit(epoch).alias("epoch"),
            F.when(left > 0, words).otherwise(F.lit(0)).cast("long").alias("words"),
            _position(begin.cast("double"), F.col("target"), F.col(target_slope)).alias("position"),
        )

    takes = F.filter(F.array(*map(take, range(max_epochs))), lambda t: t["words"] > 0)
    return placed.select(*docs.columns, "size", "source_size", "target", takes.alias("takes"))


def training_order(planned: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every document as often as it is taken, range-sorted by position."""
    take, position, tie = unused(planned.columns, "_take", "_position", "_tie")
    each = planned.select(*columns, F.explode("takes").alias(take))
    return (
        each.withColumn(position, F.col(f"{take}.position"))
        .withColumn(tie, F.xxhash64("doc_id", f"{take}.epoch"))
        .repartitionByRange(position, tie)
        .sortWithinPartitions(position, tie)
        .select(*columns)
    )


def training_ranks(planned: DataFrame) -> DataFrame:
    """doc_id, size, source_size and target of every document, and what the training takes of it.

    ``taken`` is the number of words, ``first_position`` the earliest position, and ``ranks`` are the places in the training
    order (from 0, ascending): all takes of all documents, range-sorted by position. Texts are not moved.
    """
    rows = planned.select("doc_id", "size", "source_size", "target", "takes")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "mixing-rows")
    each = rows.select("row", F.explode("takes").alias("take"), F.lit(0).alias("all"))
    each = each.select("row", "all", "take.epoch", "take.words", F.col("take.position").alias("position_of"))
    order = ["position_of", F.xxhash64("row", "epoch"), "row", "epoch"]
    ranked = numbered(each, "all", order).withColumnRenamed("position", "rank")
    # A document is taken as often as there are epochs, at most.
    found = ranked.groupBy("row").agg(
        F.sum("words").alias("taken"),
        F.min("position_of").alias("first_position"),
        F.array_sort(F.collect_list("rank")).alias("ranks"),
    )
    return rows.drop("takes").join(found, "row", "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
        "first_position",
        F.coalesce("ranks", F.array().cast("array<long>")).alias("ranks"),
    )
