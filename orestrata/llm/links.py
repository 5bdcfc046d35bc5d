"""Connected components of links, and links within groups of any size.

Both are made for groups that may hold a large share of all rows: no group is ever held
whole by a task, and a group gives about as many links as it has members, not all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.sources.scratch import materialize

LINKS = "a bigint, b bigint"
# Keys with more than this part of all rows are hot; there are fewer of them than this.
HOT_PART = 1000
# Links that a task joins into components at once, in memory.
FOREST_LINKS = 1 << 20

# (payloads of a cell, index of one, indexes of others) -> which of them it is linked with
Linked = Callable[[int, np.ndarray], np.ndarray]
Kernel = Callable[[list[bytes]], Linked]


def _forest(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked id but the smallest of its component, with that smallest, for these links."""
    ids, flat = np.unique(np.concatenate([high, low]), return_inverse=True)
    root = np.arange(len(ids))
    one, other = np.split(flat, 2)
    while len(one):
        one, other = np.maximum(root[one], root[other]), np.minimum(root[one], root[other])
        apart = one != other
        one, other = one[apart], other[apart]
        np.minimum.at(root, one, other)
        while (root[root] != root).any():
            root = root[root]
    below = np.flatnonzero(root != np.arange(len(ids)))
    return ids[below], ids[root[below]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (high, low) that connect what the given ones do, no more of them: those of every
    `FOREST_LINKS` that lie together, each id with the smallest that they reach."""
    held: list[pa.RecordBatch] = []

    def forest() -> pa.RecordBatch:
        ends = [np.concatenate([batch.column(i).to_numpy() for batch in held]) for i in (0, 1)]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(end, pa.int64()) for end in _forest(*ends)], ["high", "low"])

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= FOREST_LINKS:
            yield forest()
    if held:
        yield forest()


def _settled(pairs: DataFrame) -> tuple[int, bool]:
    """How many pairs there are, and whether they are stars: no id has two lower ends, or is
    both the lower end of one pair and the higher end of another."""
    ends = pairs.select(F.col("high").alias("id"), F.lit(1).alias("up")).unionAll(pairs.select("low", F.lit(0)))
    ids = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    open_ids = F.count_if((F.col("ups") > 1) | (F.col("ups") > 0) & (F.col("least") == 0))
    found = ids.agg(F.coalesce(F.sum("ups"), F.lit(0)), open_ids).first()
    return found[0], not found[1]


def _with_least(rows: DataFrame, least: DataFrame, key: str, most_rows: int) -> DataFrame:
    """`rows` with the `m` of their key from `least`, which counts the rows `n` of each key.

    Rows of hot keys stay where they are and meet their keys by a broadcast, fewer than
    `HOT_PART` of them; the others are shuffled. `rows` has at most `most_rows` rows.
    """
    limit = F.lit(most_rows / HOT_PART)
    hot = F.broadcast(least.filter(F.col("n") > limit).select(key, "m"))
    others = rows.join(hot.select(key), key, "left_anti").join(least.filter(F.col("n") <= limit).select(key, "m"), key)
    return rows.join(hot, key).unionByName(others)


def components(links: DataFrame) -> DataFrame:
    """Every linked id but the smallest of its component, with that smallest: id, component.

    `links` has the columns `a` and `b`, in either order, and is read twice. Tasks join about
    `FOREST_LINKS` of them each, which is all where there are no more. Else that goes on as
    long as it halves the links, and in turn each id hands its larger neighbours, then all
    its smaller ones, to the smallest neighbour. Both keep what is connected and only ever
    lower the ends of links, until each id is linked with its smallest only; the rounds grow
    with the logarithm of the ids. Each round is a written table. No id's links meet in one
    task, however many they are.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    n, settled, before = pairs.count(), False, None
    while not settled:
        if before is not None and 2 * n > before:
            pairs, before = _stars(pairs, n).distinct(), None
        else:
            tasks = max(1, -(-n // FOREST_LINKS))
            pairs, before = pairs.coalesce(tasks).mapInArrow(_forests, "high bigint, low bigint"), n
            if tasks == 1:
                pairs = materialize(pairs, "links")
                break
            pairs = pairs.distinct()
        pairs = materialize(pairs, "links")
        n, settled = _settled(pairs)
    return pairs.select(F.col("high").alias("id"), F.col("low").alias("component"))


def _stars(pairs: DataFrame, n: int) -> DataFrame:
    """The `n` pairs after each id has handed its larger neighbours, then all its smaller ones,
    to the smallest neighbour."""
    both = pairs.select(F.col("high").alias("u"), F.col("low").alias("v")).unionAll(
        pairs.select(F.col("low").alias("u"), F.col("high").alias("v"))
    )
    count = F.count(F.lit(1)).alias("n")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), count)
    large = _with_least(both.filter("v > u"), least, "u", 2 * n)
    large = large.select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
    lowest = large.groupBy("high").agg(F.min("low").alias("m"), count)
    small = _with_least(large, lowest, "high", n).filter("low <> m")
    small = small.select(F.col("low").alias("high"), F.col("m").alias("low"))
    return small.unionAll(lowest.select("high", F.col("m").alias("low")))


def _spanning(size: int, linked: Linked) -> Iterator[tuple[int, int]]:
    """Links that connect the same members as all links do: each member with the first of
    its component. A member is compared only with those not reached yet."""
    left = np.arange(size)
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            hit = linked(queue.pop(), left)
            found, left = left[hit], left[~hit]
            queue.extend(found)
            for member in found:
                yield root, member


def _cell_links(kernel: Kernel):
    """Links of each cell, from rows (cell, id, payload) sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, bytes] = {}
        current = None

        def close(found: list[tuple[int, int]]) -> None:
            if len(held) > 1:
                ids = list(held)
                for a, b in _spanning(len(ids), kernel(list(held.values()))):
                    found.append((ids[a], ids[b]))
            held.clear()

        def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
            columns = [pa.array([pair[i] for pair in found], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            found: list[tuple[int, int]] = []
            cells = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
            for cell, key, payload in zip(cells, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if cell != current:
                    close(found)
                    current = cell
                held[key] = payload
            yield batch_of(found)
        found = []
        close(found)
        yield batch_of(found)

    return run


def _run_cells(cells: DataFrame, payloads: DataFrame, kernel: Kernel) -> DataFrame:
    # In the order of ids, a member meets the same smallest one in each group that both are in.
    keys = ["group", "part", "other"]
    rows = cells.join(payloads, "id").select(*keys, "id", "payload")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(_cell_links(kernel), LINKS)


def spanning_links(members: DataFrame, payloads: DataFrame, kernel: Kernel, cell_size: int) -> DataFrame:
    """Links that connect the members of each group as all its links would: a written table.

    `members` has `group`, `id` and `weight`, `payloads` one binary `payload` per `id`.
    `kernel` takes the payloads of a cell and tells which members are linked with a given one.

    A group of members that weigh at most about `cell_size` is one cell, searched whole. A
    larger one is dealt over cells, each of which also gets the group's smallest member.
    Where that leaves it in several components, every member outside its largest component
    meets every other member, in cells of up to twice the size, so no link is lost.
    """

    def cells_of(n: str, weight: str) -> Column:
        return F.least(n, F.ceil(F.col(weight) / cell_size)).cast("int")

    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("all"), F.min("id").alias("hub"))
    sizes = sizes.filter("n > 1").withColumn("parts", cells_of("n", "all"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = materialize(
        members.join(sizes.select("group", "parts", "hub"), "group").select("group", "id", "weight", "hub", "parts", part.alias("part")),
        "cells",
    )
    none = F.lit(0).alias("other")
    large = placed.filter("parts > 1")
    hubs = large.groupBy("group", "hub", "parts").agg(F.count(F.lit(1)))
    hubs = hubs.select("group", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), none, F.col("hub").alias("id"))
    cells = placed.select("group", "part", none, "id").unionAll(hubs)
    links = materialize(_run_cells(cells, payloads, kernel).distinct(), "links")
    if large.isEmpty():
        return links

    component = F.coalesce("component", "id")
    known = large.join(components(links), "id", "left").withColumn("component", component)
    counted = known.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("all"))
    order = F.struct("n", "component")
    open_groups = counted.groupBy("group").agg(
        F.max_by("component", order).alias("largest"),
        (F.sum("n") - F.max("n")).alias("apart"),
        (F.sum("all") - F.max_by("all", order)).alias("apart_weight"),
    ).filter("apart > 0")
    known = known.join(open_groups, "group").withColumn("apart_parts", cells_of("apart", "apart_weight"))
    everyone = known.select(
        "group", "part", F.explode(F.sequence(F.lit(0), F.col("apart_parts") - 1)).alias("other"), "id"
    )
    apart = known.filter("component <> largest").select(
        "group",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.col("apart_parts")).cast("int").alias("other"),
        "id",
    )
    more = _run_cells(everyone.unionAll(apart).distinct(), payloads, kernel)
    return materialize(links.unionAll(more).distinct(), "links")
