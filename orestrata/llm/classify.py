"""Quality selection by importance resampling.

Two models of hashed words and word pairs, one of target text and one of all text, give
each document the logarithm of how much likelier the target model makes it, per n-gram, so
that long documents do not outweigh short ones. Gumbel top-k then draws documents without
replacement by these importance weights.

The target model is counted on a bounded sample of labelled documents, the raw model on
every document. Where labels exist, the number to draw is calibrated on labelled documents
that the target model has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.words import WordHashes, chained, word_slices
from orestrata.sources.scratch import materialize

MIN_COUNT = 0.5


@dataclass(frozen=True)
class Settings:
    """`slots`: hashed n-grams of each order; the models' size, whatever the corpus.
    `labelled`: labelled documents used at most, half to count, half to calibrate.
    `temperature`: how random the draw is, in units of the log weight per n-gram; at 0 the
    k likeliest documents are drawn.
    `keep_good`: share of the good calibration documents that the draw should keep."""

    slots: int = 1 << 15
    labelled: int = 20_000
    temperature: float = 0.005
    keep_good: float = 0.998
    seed: int = 7


def _slots(words: np.ndarray, counts: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each word and of each pair of neighbours, and the row each belongs to."""
    row = np.repeat(np.arange(len(counts)), counts)
    pairs = chained(words, 2) if len(words) > 1 else np.empty(0, np.uint64)
    inside = row[:-1] == row[1:]
    one = words % np.uint64(slots)
    two = pairs[inside] % np.uint64(slots) + np.uint64(slots)
    return np.concatenate([one, two]).astype(np.int64), np.concatenate([row, row[:-1][inside]])


def _count(slots: int):
    """(text, target) -> (slot, raw, target) totals of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        totals = np.zeros((2, 2 * slots), np.int64)
        for batch in batches:
            marks = np.array(batch.column("target").to_pylist(), bool)
            for first, words, counts in word_slices(batch.column("text"), hashes):
                slot, row = _slots(words, counts, slots)
                totals[0] += np.bincount(slot, minlength=2 * slots)
                totals[1] += np.bincount(slot[marks[first + row]], minlength=2 * slots)
        (seen,) = np.nonzero(totals[0])
        columns = [pa.array(seen), pa.array(totals[0][seen]), pa.array(totals[1][seen])]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "raw", "target"])

    return run


def _score(weights: np.ndarray, slots: int):
    """(doc_id, text, ...) -> (doc_id, ..., log_weight)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rest = [n for n in batch.schema.names if n != "text"]
            for first, words, counts in word_slices(batch.column("text"), hashes):
                slot, row = _slots(words, counts, slots)
                sums = np.bincount(row, weights[slot], minlength=len(counts))
                sums /= np.maximum(1, np.bincount(row, minlength=len(counts)))
                part = batch.slice(first, len(counts))
                columns = [part.column(n) for n in rest] + [pa.array(sums, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*rest, "log_weight"])

    return run


def log_ratios(counts: DataFrame, slots: int) -> np.ndarray:
    """Logarithm of target over raw probability of each slot, orders apart.

    At most 2 x `slots` rows reach the driver. A slot the target model lacks counts as
    `MIN_COUNT`; without any target text all ratios are 0.
    """
    totals = np.zeros((2, 2 * slots))
    rows = counts.groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    totals[0, rows["slot"]], totals[1, rows["slot"]] = rows["raw"], rows["target"]
    ratios = np.zeros(2 * slots)
    for order in (slice(0, slots), slice(slots, 2 * slots)):
        raw, target = totals[0, order], totals[1, order]
        if target.sum():
            # The target is part of the raw text: shrink its probabilities towards the raw ones.
            raw_p = (raw + MIN_COUNT) / (raw + MIN_COUNT).sum()
            target_p = (target + MIN_COUNT * raw_p * slots) / (target.sum() + MIN_COUNT * slots)
            ratios[order] = np.log(target_p) - np.log(raw_p)
    return ratios


def _at_rank(scores: DataFrame, column: str, rank: int, bins: int = 4096) -> float:
    """The value with `rank` values above or equal to it, found by counting in ever finer
    bins; at most `bins` counts reach the driver a round."""
    low, high = scores.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / bins
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
        inside = scores.filter(F.col(column).between(low, high))
        found = inside.groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(found.collect(), key=lambda r: -r.bin):
            if above + row.n >= rank:
                low, high = row.low, row.high
                break
            above += row.n
    return low


def uniform(seed: int, *columns: Column) -> Column:
    """A number above 0 and below 1 that is the same for the same row on every run."""
    return (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


def select_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, text_hash, log_weight, sampling_key, selected.

    `labels` marks good documents by quality 1 and toxic not 1; those are target text. The
    number k of documents drawn is the number whose log weight is at least the value that
    `keep_good` of the good calibration documents reach. Without such documents every
    weight is 0 and all rows are selected.

    Null text counts as empty: weight 0. A null doc_id has no label. Rows that share a
    doc_id share its label; equal rows get equal keys and stand or fall together, as do all
    rows tied at the k-th key, so slightly more than k rows may be selected. Other columns
    are ignored. An empty table gives an empty result. Writes to the shared folder.
    """
    scores, kept = _scored(docs, labels, settings)
    rows = scores.count()
    if not rows:
        return scores.select("doc_id", "text_hash", "log_weight", F.lit(0.0).alias("sampling_key"), F.lit(True).alias("selected"))
    gumbel = -F.log(-F.log(uniform(settings.seed, F.col("doc_id"), F.col("text_hash"))))
    scores = scores.withColumn("sampling_key", F.col("log_weight") + settings.temperature * gumbel)
    k = scores.filter(F.col("log_weight") >= kept).count() if kept is not None else rows
    cut = _at_rank(scores, "sampling_key", k) if 0 < k < rows else None
    selected = F.lit(k > 0) if cut is None else F.col("sampling_key") >= cut
    return scores.select("doc_id", "text_hash", "log_weight", "sampling_key", selected.alias("selected"))


def _scored(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, float | None]:
    """The documents with their log weights, written, and the calibrated weight to reach."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    by_hash = F.xxhash64(F.lit(settings.seed), F.col("doc_id"))
    sample = (
        labels.filter(good & F.col("doc_id").isNotNull()).select("doc_id").distinct()
        .orderBy(by_hash, "doc_id").limit(settings.labelled)
        .select("doc_id", (F.pmod(by_hash, F.lit(2)) == 0).alias("counted"))
    )
    # The sample is bounded by `labelled`, so it may be broadcast.
    text = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left")
    counted = text.select("text", F.coalesce("counted", F.lit(False)).alias("target"))
    counts = counted.mapInArrow(_count(settings.slots), "slot bigint, raw bigint, target bigint")
    weights = log_ratios(counts, settings.slots)
    held_out = (~F.col("counted")).alias("held_out")
    scores = text.select("doc_id", F.xxhash64("text").alias("text_hash"), held_out, "text").mapInArrow(
        _score(weights, settings.slots), "doc_id bigint, text_hash bigint, held_out boolean, log_weight double"
    )
    scores = materialize(scores, "scores")
    calibration = scores.filter("held_out")
    n = calibration.count()
    if not n:
        return scores, None
    return scores, _at_rank(calibration, "log_weight", max(1, round(settings.keep_good * n)))
