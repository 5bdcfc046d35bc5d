"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, its source's target over its
source's size. Prefix sums of the expected copies within the source, plus one random offset
per source, cross whole numbers; a document is emitted once for each it crosses. As
documents come in order of size, the words taken differ from the target by about one
largest document at most, however many documents there are.

A prefix sum of equal steps is a document's position times the step. Positions are found in
three levels, so that neither a source with a third of all rows nor one whose texts are all
of one length is one task: documents fall into size classes, and classes into as many blocks
as the count of the largest asks for. Counts of blocks are summed up per class, those of classes per
source, and rows are numbered within their block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.sources.scratch import materialize

# Size classes per doubling of the size.
CLASSES = 8
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """`weights` go to the sources by code point of their names, null last, and repeat.
    `share`: words of the mix over words of all sources. `ceiling`: times a source's words
    that its target may reach. `block`: rows that are numbered in one task, about."""

    weights: Sequence[int] = (3, 1, 2)
    share: float = 1.5
    ceiling: int = 2
    block: int = 100_000
    seed: int = 11


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Target words per source: source, source_size, target.

    `sizes` has one row per source with its `source_size`. The common level, words per unit
    of weight, rises while sources stop at their ceilings: with the sources ordered by
    ceiling over weight, it is the largest of the levels that result when the first 0, 1,
    2, ... of them are taken to have stopped.

    All rows meet in one task, one per source; nothing else does.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(mix.weights)))
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (place + 1).cast("int")).cast("bigint")
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * mix.ceiling)
    early = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = early.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    words = F.sum("source_size").over(everything).cast("double") * mix.share
    stopped = F.coalesce(F.sum("most").over(before), F.lit(0)).cast("double")
    going = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", (words - stopped) / going.cast("double"))
    level = F.max("level").over(everything)
    target = F.least(F.col("most").cast("double"), F.greatest(F.lit(0.0), F.col("weight").cast("double") * level))
    return rows.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, mix: Mix = Mix(), columns: Sequence[str] | None = None) -> DataFrame:
    """Every document with what the mix takes of it: all or the named `columns` of `docs` in
    one struct `row`, and size, source_size, target, copies, taken.

    `size` counts words, `taken` is size x copies. Copies are 0 up to the ceiling. The draw
    depends on source names, doc_ids, texts and the seed alone, so reruns agree.

    A null text has size 0; a null source is a source of its own, last by name; a null
    doc_id is a value like any other. Repeated rows are drawn one by one. A source without
    words has target 0 and gives no copies. Other columns are carried along in `row`. An
    empty table gives an empty result. Writes sizes and counts to the shared folder.
    """
    kept = [F.col(c) for c in (docs.columns if columns is None else columns)]
    sized = docs.select(
        F.struct(*kept).alias("row"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(mix.seed), "doc_id", "text").alias("draw"),
        F.coalesce("source", F.lit("")).alias("name"),
        F.col("source").isNull().alias("unnamed"),
    )
    grade = F.coalesce(F.floor(F.log2(F.col("size") + 1) * CLASSES), F.lit(0)).cast("int")
    sized = sized.withColumn("grade", grade)
    source_keys = ["name", "unnamed"]
    classes_keys = [*source_keys, "grade"]
    slim = materialize(sized.select(*classes_keys, "size", "draw"), "sizes")
    classes = slim.groupBy(*classes_keys).agg(F.count(F.lit(1)).alias("class_rows"), F.sum("size").alias("words"))
    classes = materialize(classes, "classes")  # sources x size classes rows at most
    largest = classes.agg(F.max("class_rows")).first()[0] or 1
    block = F.pmod("draw", F.lit(-(-largest // mix.block)))

    source = F.when(~F.col("unnamed"), F.col("name"))
    targets = source_targets(classes.groupBy(*source_keys).agg(F.sum("words").alias("source_size")).withColumn("source", source), mix)
    targets = targets.select(
        F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("unnamed"), "source_size", "target"
    )
    preceding = (Window.unboundedPreceding, -1)
    larger = Window.partitionBy(*source_keys).orderBy(F.desc("grade")).rowsBetween(*preceding)
    plan = classes.withColumn("class_start", F.coalesce(F.sum("class_rows").over(larger), F.lit(0)))
    plan = plan.join(targets, source_keys).drop("class_rows", "words")

    keys = [*classes_keys, "block"]
    counts = slim.withColumn("block", block).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*classes_keys).orderBy("block").rowsBetween(*preceding)
    starts = counts.withColumn("block_start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    starts = materialize(starts.join(plan, classes_keys), "starts")

    within = Window.partitionBy(*keys).orderBy(F.desc("size"), "draw")
    placed = sized.withColumn("block", block).join(starts, keys).withColumn("number", F.row_number().over(within))

    step = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    random = F.xxhash64(F.lit(mix.seed), "name", "unnamed")
    offset = F.pmod(random, F.lit(1 << 40)) / F.lit(float(1 << 40))
    last = F.col("class_start") + F.col("block_start") + F.col("number")
    crossed = F.floor(offset + step * last) - F.floor(offset + step * (last - 1))
    copies = F.least(crossed, F.lit(mix.ceiling)).cast("bigint")
    return placed.select("row", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it has copies, with its own columns."""
    return mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")
