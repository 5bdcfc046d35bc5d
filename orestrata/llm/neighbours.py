"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits a bounded sample of vectors again and again by the hyperplane between two
random ones, moved to the middles of the two halves of a few members, down to leaves of a few
sampled vectors. Every vector is filed in one leaf of each tree. A query walks all trees at
once, through one priority queue of branches ordered by how far beyond the splits above them
they lie, until the leaves it has opened hold enough vectors. The vectors of those leaves are
reranked by exact cosine.

Leaves meet their queries in blocks, so vectors travel once per tree and queries once per
opened leaf; a leaf with very many vectors is dealt over several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.words import mix
from orestrata.sources.scratch import materialize


@dataclass(frozen=True)
class Settings:
    """`sample`: vectors the forest is fitted on at most; it bounds the forest, which goes to
    all tasks. `leaf`: sampled vectors per leaf at most. `search`: vectors that a query
    looks at, those in leaves of several trees counted in each; `share`: the same as a part
    of all vectors, if that is more. `halving`: members that a split is fitted on, in
    `rounds` rounds. `block`: vectors of a leaf per task block."""

    trees: int = 16
    sample: int = 20_000
    leaf: int = 32
    search: int = 6_000
    share: float = 0.35
    halving: int = 128
    rounds: int = 3
    block: int = 5_000
    seed: int = 3


@dataclass(frozen=True)
class Tree:
    """Inner nodes by number: a hyperplane through 0 or not (normal, offset) and two children.
    A negative child is a leaf, numbered from -1 downwards."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray


def split(members: np.ndarray, rounds: int, random: np.random.Generator) -> tuple[np.ndarray, float]:
    """A hyperplane (unit normal, offset) between the middles of two halves of the members."""
    one, two = members[random.choice(len(members), 2, replace=False)]
    for _ in range(rounds):
        side = members @ (one - two) > (one - two) @ (one + two) / 2
        if side.all() or not side.any():
            break
        one, two = members[side].mean(axis=0), members[~side].mean(axis=0)
    normal = (one - two) / max(np.linalg.norm(one - two), 1e-300)
    return normal, float(normal @ (one + two) / 2)


def grow(sample: np.ndarray, settings: Settings, random: np.random.Generator) -> Tree:
    """A tree over unit vectors."""
    normals, offsets, children = [], [], []
    leaves = 0

    def place(members: np.ndarray) -> int:
        nonlocal leaves
        if len(members) > settings.leaf:
            drawn = random.choice(members, min(len(members), settings.halving), replace=False)
            normal, offset = split(sample[drawn], settings.rounds, random)
            side = sample[members] @ normal > offset
            if side.any() and not side.all():
                number = len(normals)
                normals.append(normal)
                offsets.append(offset)
                children.append((0, 0))
                children[number] = place(members[~side]), place(members[side])
                return number
        leaves += 1
        return -leaves

    root = place(np.arange(len(sample)))
    if root < 0:  # a tree of one leaf
        normals, offsets, children = [np.zeros(sample.shape[1])], [np.inf], [(-1, -1)]
    return Tree(np.array(normals), np.array(offsets), np.array(children))


def leaf_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector."""
    node = np.zeros(len(vectors), np.int64)
    going = np.arange(len(vectors))
    while len(going):
        at = node[going]
        right = np.einsum("ij,ij->i", vectors[going], tree.normals[at]) > tree.offsets[at]
        node[going] = tree.children[at, right.astype(int)]
        going = going[node[going] >= 0]
    return node


def open_leaves(forest: list[Tree], sizes: list[dict[int, int]], vector: np.ndarray, search: int) -> Iterator[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue, until they hold `search` vectors. A
    branch comes by the sum of the squared distances to the splits that it lies beyond."""
    queue = [(0.0, t, 0) for t in range(len(forest))]
    margins = [tree.normals @ vector - tree.offsets for tree in forest]
    held = 0
    while queue and held < search:
        beyond, t, node = heappop(queue)
        if node < 0:
            size = sizes[t].get(node, 0)
            if size:
                held += size
                yield t, node
            continue
        margin = float(margins[t][node])
        low, high = forest[t].children[node].tolist()
        heappush(queue, (beyond + max(margin, 0.0) ** 2, t, low))
        heappush(queue, (beyond + max(-margin, 0.0) ** 2, t, high))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, and all of its components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, which changes no bit of a cosine, so that squares
    neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _file(forest: list[Tree], blocks: list[dict[int, int]] | None = None):
    """(id, vector) -> one row per tree with its leaf and, if asked for, block and vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unit(_matrix(batch.column("vector")))
            salt = mix(batch.column("id").to_numpy().astype(np.uint64))
            for number, tree in enumerate(forest):
                leaf = leaf_of(tree, vectors)
                place = [pa.array(np.full(len(vectors), number, np.int32)), pa.array(leaf)]
                if blocks is None:
                    yield pa.RecordBatch.from_arrays(place, ["tree", "leaf"])
                    continue
                parts = np.array([blocks[number][one] for one in leaf.tolist()], np.uint64)
                place += [pa.array((salt % parts).astype(np.int32)), pa.array(np.zeros(len(leaf), np.int32))]
                yield pa.RecordBatch.from_arrays([*place, *batch.columns], ["tree", "leaf", "block", "role", "id", "vector"])

    return run


def _probe(forest: list[Tree], sizes: list[dict[int, int]], blocks: list[dict[int, int]], search: int):
    """(id, vector) of queries -> one row per block of the leaves that they open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _unit(_matrix(batch.column("vector")))
            opened = [
                (row, tree, leaf, block)
                for row, vector in enumerate(vectors)
                for tree, leaf in open_leaves(forest, sizes, vector, search)
                for block in range(blocks[tree][leaf])
            ]
            row, *place = (np.array(column) for column in zip(*opened, strict=True))
            kinds = (pa.int32(), pa.int64(), pa.int32())
            columns = [pa.array(column).cast(kind) for column, kind in zip(place, kinds, strict=True)]
            columns.append(pa.array(np.ones(len(row), np.int32)))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*columns, *taken.columns], ["tree", "leaf", "block", "role", "id", "vector"])

    return run


def _rerank(k: int):
    """Rows sorted by block, its vectors before its queries -> the k best other keys for each
    query, with the best score of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        ids = vectors = lengths = None
        for batch in batches:
            found: list[tuple] = []
            names = ("tree", "leaf", "block", "role")
            marks = np.column_stack([batch.column(name).to_numpy() for name in names]) if batch.num_rows else np.empty((0, 4))
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for start, end in pairwise([0, *cuts.tolist(), len(marks)]) if len(marks) else []:
                block, role = tuple(marks[start, :3]), marks[start, 3]
                own = batch.column("id").slice(start, end - start).to_numpy()
                part = _scaled(_matrix(batch.column("vector").slice(start, end - start)))
                if block != current:
                    current, held, ids = block, [], None
                if role == 0:
                    held.append((own, part))
                    continue
                if not held:
                    continue
                if ids is None:
                    ids, vectors = (np.concatenate(column) for column in zip(*held, strict=True))
                    lengths = np.sqrt((vectors * vectors).sum(axis=1))
                for query_id, query in zip(own.tolist(), part, strict=True):
                    # Summed row by row, so that equal vectors get equal scores.
                    scores = (vectors * query).sum(axis=1) / (lengths * np.sqrt((query * query).sum()))
                    best: dict[int, float] = {}
                    for i in np.lexsort((ids, -scores)):
                        if ids[i] != query_id:
                            best.setdefault(int(ids[i]), float(scores[i]))
                            if len(best) == k:
                                break
                    found += [(query_id, *one) for one in best.items()]
            kinds = (pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return run


_FILED = "tree int, leaf bigint, block int, role int, id bigint, vector "


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The `k` nearest found of each row for which `is_query` holds, among all other rows:
    query_id, rank (from 1), vec_id, score (cosine, in double precision).

    Nearest first, ties to the smaller key. All candidates are returned if they are fewer.
    Vectors that are null, empty, zero or of another length than most, or that hold null or
    non-finite components, take no part, and so do null keys; rows that repeat a key are one
    candidate. Other columns are ignored. An empty table gives an empty result.

    Of equal vectors only the k + 1 smallest keys are candidates, as no others can be among
    the k nearest. Leaves are searched whole.
    """
    # Floats travel as floats; tasks widen them, which is exact.
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast(kind).alias("vector"), is_query.alias("query"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if usual is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.filter(F.size("vector") == usual.n)
    same = Window.partitionBy("vector").orderBy("id")
    # Repeated rows go first, or they would use up the places of other keys.
    stored = rows.select("id", "vector").distinct().withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1)
    stored = materialize(stored.select("id", "vector"), "vectors")

    picked = stored.orderBy(F.xxhash64(F.lit(settings.seed), "id"), "id").limit(settings.sample).select("vector")
    sample = _unit(np.array([row.vector for row in picked.collect()]))
    random = np.random.default_rng(settings.seed)
    forest = [grow(sample, settings, random) for _ in range(settings.trees)]
    # One count per leaf, and the sample bounds the leaves.
    counts = stored.mapInArrow(_file(forest), "tree int, leaf bigint").groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = [{row.leaf: row.n for row in counts if row.tree == t} for t in range(len(forest))]
    blocks = [{leaf: -(-n // settings.block) for leaf, n in tree.items()} for tree in sizes]
    total = sum(sizes[0].values())
    search = max(settings.search, int(settings.share * total))

    filed = stored.mapInArrow(_file(forest, blocks), _FILED + kind)
    queries = rows.filter("query").select("id", "vector")
    probes = queries.mapInArrow(_probe(forest, sizes, blocks, search), _FILED + kind)
    place = ["tree", "leaf", "block"]
    meeting = filed.unionAll(probes).repartition(*place).sortWithinPartitions(*place, "role")
    found = meeting.mapInArrow(_rerank(k), "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
