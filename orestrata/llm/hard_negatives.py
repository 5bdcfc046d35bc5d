"""Hard negatives by Fagin's threshold algorithm.

Vectors become whole numbers, so scores are exact inner products. All rows are dealt over
blocks of bounded size; in a block every dimension has a list of the rows sorted by it. An
anchor reads all lists at once, from the end that its own sign makes the best, and scores
each row that it meets for the first time by random access. No row still unmet can score
more than the threshold, the anchor's product with the values where it stands in the lists.
A search ends once the threshold lies strictly below the score of the last place of every
window, or below the window itself. The best of all blocks are then ranked.

Anchors search twice: for their positives, and for the windows that these open.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    """`positives` of an anchor, `negatives` of a window; a window takes scores from `low` to
    `high` percent of its positive's. `scale`: whole units of 1. `block`: rows of a block, about;
    `step`: places read in each list before the first look at the threshold, then doubled."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256
    block: int = 4096
    step: int = 16


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, which add and multiply whole numbers exactly as long as
    results, a hundredfold, stay below 2^53; beyond that as Python's numbers."""
    values = np.floor(vectors * scale)
    if values.size and np.abs(values).max() ** 2 * values.shape[1] >= 2.0**46:
        return np.array([[int(x) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)
    return values


class Block:
    """Rows of a block with their sorted lists, one for all rows or one per label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[by_id], labels[by_id], vectors[by_id]
        self.lists: dict[int | None, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_lists(self, label: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows, by number, in the order of each dimension, and their values there."""
        if label not in self.lists:
            rows = np.arange(len(self.ids)) if label is None else np.flatnonzero(self.labels == label)
            order = np.argsort(self.vectors[rows], axis=0, kind="stable")
            self.lists[label] = rows[order], np.take_along_axis(self.vectors[rows], order, axis=0)
        return self.lists[label]


def threshold_search(
    block: Block, anchor: np.ndarray, windows: list[tuple[int | None, int | None]], k: int, percent: int,
    step: int, among: int | None = None, without: int | None = None, itself: int | None = None,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows (by number) with the `k` best scores of each window, ties to the smaller id, and the
    scores of all rows. A window holds scores whose `percent`-fold lies between its bounds,
    none being open. `among` and `without` are a label to search and one to leave out."""
    order, values = block.sorted_lists(among)
    size = len(order)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    seen = np.zeros(len(block.ids), bool)
    scores = np.zeros(len(block.ids), anchor.dtype)
    best = [np.empty(0, np.int64) for _ in windows]
    ended = [False] * len(windows)
    start, stop = 0, min(step, size)
    while size and not all(ended):
        met = np.concatenate([order[size - stop : size - start, up].ravel(), order[start:stop, down].ravel()])
        if not len(up) and not len(down):  # an anchor of zeros: all rows score 0
            met, stop = order[:, 0], size
        fresh = np.zeros(len(block.ids), bool)
        fresh[met] = True
        fresh &= ~seen
        seen |= fresh
        new = np.flatnonzero(fresh)
        scores[new] = block.vectors[new] @ anchor
        threshold = values[size - stop, up] @ anchor[up] + values[stop - 1, down] @ anchor[down]
        allowed = new[(block.ids[new] != itself) & (block.labels[new] != without)] if len(new) else new
        for i, (low, high) in enumerate(windows):
            if ended[i]:
                continue
            inside = allowed
            if low is not None:
                inside = inside[scores[inside] * percent >= low]
            if high is not None:
                inside = inside[scores[inside] * percent <= high]
            found = np.concatenate([best[i], inside])
            # Rows of a block are numbered by id.
            best[i] = found[np.lexsort((found, -scores[found]))][:k]
            full = len(best[i]) == k and threshold < scores[best[i][-1]]
            ended[i] = stop == size or full or (low is not None and threshold * percent < low)
        start, stop = stop, min(size, 2 * stop)
    return best, scores


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], pa.int64()) for i in range(len(names))], list(names))


def _in_blocks(search, names: tuple[str, ...]):
    """Rows (block, kind, id, label, vector, positives) sorted by block and kind: the rows of a
    block, then the anchors that search it, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for batch in batches:
            found: list[tuple] = []
            if batch.num_rows:
                numbers = batch.column("block").to_numpy() * 2 + batch.column("kind").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
                for start, end in zip(cuts, cuts[1:], strict=False):
                    rows = batch.slice(start, end - start)
                    number, anchors = divmod(int(numbers[start]), 2)
                    if number != current:
                        current, parts, block = number, [], None
                    ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
                    vectors = _matrix(rows.column("vector"))
                    if not anchors:
                        parts.append((ids, labels, vectors))
                        continue
                    if block is None and parts:
                        block = tuple(np.concatenate(column) for column in zip(*parts, strict=True))
                    if block is None:  # no row was dealt here
                        continue
                    found += search(block, ids, labels, vectors, rows.column("positives").to_pylist())
            yield _batch(found, names)

    # The built block is kept between batches of its anchors.
    return run


def _prepared(block: tuple, anchors: np.ndarray, scale: int, cache: dict) -> tuple[Block, np.ndarray]:
    ids, labels, vectors = block
    both = whole(np.concatenate([vectors, anchors]), scale)
    wide = both.dtype == object
    if cache.get("of") is not vectors or cache["wide"] != wide:
        cache.update(of=vectors, wide=wide, block=Block(ids, labels, both[: len(vectors)]))
    return cache["block"], both[len(vectors) :]


def _find_positives(settings: Settings):
    cache: dict = {}

    def search(block, ids, labels, vectors, _):
        lists, anchors = _prepared(block, vectors, settings.scale, cache)
        for key, label, anchor in zip(ids.tolist(), labels.tolist(), anchors, strict=True):
            (best,), scores = threshold_search(
                lists, anchor, [(None, None)], settings.positives, 100, settings.step, among=label, itself=key
            )
            yield from ((key, int(lists.ids[row]), int(scores[row])) for row in best)

    return search


def _find_negatives(settings: Settings):
    cache: dict = {}

    def search(block, ids, labels, vectors, positives):
        lists, anchors = _prepared(block, vectors, settings.scale, cache)
        for key, label, anchor, own in zip(ids.tolist(), labels.tolist(), anchors, positives, strict=True):
            windows = [(settings.low * p["score"], settings.high * p["score"]) for p in own]
            best, scores = threshold_search(lists, anchor, windows, settings.negatives, 100, settings.step, without=label)
            for positive, rows in zip(own, best, strict=True):
                for row in rows:
                    yield key, positive["id"], positive["score"], int(lists.ids[row]), int(scores[row])

    return search


def _ranked(found: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def taking_part(vectors: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """id, label, vector of the rows that take part, one per id."""
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite)
    usual = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    if usual:
        rows = rows.filter(F.size("vector") == usual.n)
    least = F.min(F.struct("label", "vector"))
    return rows.groupBy("id").agg(least.alias("row")).select("id", "row.label", "row.vector")


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, settings: Settings = Settings(),
    key: str = "vec_id", vector: str = "embedding", label: Column | None = None,
) -> DataFrame:
    """For each anchor and each of its positives, the first rows of other labels whose score lies
    in the positive's window: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    `is_anchor` is a condition on `id`. A score is the integer inner product with the anchor of
    floor(scale * component); higher scores come first, ties by smaller id. An anchor's positives
    are its first other rows of its label; all rows count if there are fewer.

    Rows whose id, label or vector is null, whose vector is empty, of another length than most
    (the longer, if as many), or holds a null or non-finite component take no part. Of rows that
    repeat an id the one with the least label and vector takes part. A score beyond 64 bits is
    an error. Other columns are ignored; an empty table gives an empty result.
    """
    rows = materialize(taking_part(vectors, key, vector, F.col("label") if label is None else label), "vectors")
    total = rows.count()
    if not total:
        return vectors.sparkSession.createDataFrame([], RESULT)
    kind = rows.schema["vector"].dataType.simpleString()
    parts = -(-total // settings.block)
    own = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    wanted = "array<struct<id:bigint,score:bigint>>"
    meeting = f"block int, kind int, id bigint, label bigint, vector {kind}, positives {wanted}"
    names = [part.split()[0] for part in meeting.split(", ")]
    anchors = rows.filter(is_anchor)

    def met(searching: DataFrame) -> DataFrame:
        """Every block with all anchors that search it."""
        none = F.lit(None).cast(wanted).alias("positives")
        dealt = rows.select(own.alias("block"), F.lit(0).alias("kind"), "id", "label", "vector", none)
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("block")
        queries = searching.select(everywhere, F.lit(1).alias("kind"), "id", "label", "vector", "positives")
        both = dealt.unionAll(queries.select(*names))
        return both.repartitionById(parts, F.col("block")).sortWithinPartitions("block", "kind")

    columns = ("anchor_id", "positive_id", "positive_score")
    found = met(anchors.withColumn("positives", F.lit(None).cast(wanted))).mapInArrow(
        _in_blocks(_find_positives(settings), columns), ", ".join(f"{c} bigint" for c in columns)
    )
    positives = _ranked(found, ["anchor_id"], "positive_score", "positive_id", settings.positives)
    listed = positives.groupBy(F.col("anchor_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives")
    )
    searching = materialize(anchors.join(listed, "id"), "anchors")
    columns = (*columns, "negative_id", "negative_score")
    found = met(searching).mapInArrow(_in_blocks(_find_negatives(settings), columns), ", ".join(f"{c} bigint" for c in columns))
    best = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", settings.negatives)
    return best.select(*[part.split()[0] for part in RESULT.split(", ")])
