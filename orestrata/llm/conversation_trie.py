"""Trie of the prefixes that conversations share, built in range shards around a skeleton.

A path is a conversation as bytes: one record of fixed width per turn, the hash of its role
and text and the length of the text. Sorted paths bring all conversations below a node
together, so a shard of a range partition finishes every node that lies wholly inside it,
with one pass and a stack as deep as a path. A node that reaches into several shards is a
prefix of one of the splitter paths between them. These prefixes are the skeleton: the
splitters go to all tasks, each shard gives a partial aggregate of the skeleton nodes it
meets, and the partials are reduced, first by node and then along the skeleton's branches.

Equal paths are combined before they are sharded, so copies of one conversation cost one row.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.sources.scratch import materialize

# Bytes of a turn's record: the hash, then the length of its text in code points.
HASH_BYTES, LENGTH_BYTES = 16, 4
RECORD = HASH_BYTES + LENGTH_BYTES
# Bounds of the skeleton, which goes to all tasks: splitters, and turns of a splitter. Sampled
# paths per splitter, and ids written in one row of the lists that are hashed.
MOST_SHARDS = 4096
MOST_TURNS = 64
SAMPLED = 32
ID_BLOCK = 4096

NOBODY = hashlib.sha256(b"").hexdigest()


def record(role: Column, text: Column) -> Column:
    """A turn's record in hexadecimal. A null role or text is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    # The role's length keeps role and text apart.
    mark = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(mark, 1, 2 * HASH_BYTES), F.lpad(F.hex(F.length(text)), 2 * LENGTH_BYTES, "0"))


def turn_paths(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The path of each conversation: conv_id, path.

    Turns go by number, null first; those of one number by their record. Repeated rows are
    turns of their own, rows without a conversation none. Other columns are ignored. A
    conversation's records, not its texts, meet in one task.
    """
    rows = turns.select(
        F.col(key).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), record(F.col(role), F.col(text)).alias("record")
    ).filter("conv_id IS NOT NULL")
    line = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "record")))
    path = F.unhex(F.array_join(F.transform(line, lambda t: t["record"]), ""))
    return rows.groupBy("conv_id").agg(path.alias("path"))


def first_turns(path: Column, turns: Column) -> Column:
    return F.substring(path, F.lit(1), turns * RECORD)


def without_first_turns(path: Column, turns: Column) -> Column:
    return F.substring(path, turns * RECORD + 1, F.length(path))


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, block, n, first, ids) sorted by path and block -> one row per path, with the
    hash of all its ids in a line."""
    current, state = None, None
    n = first = 0

    def row_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "n", "first", "ends"])

    for batch in batches:
        done = []
        for path, count, least, ids in zip(*[batch.column(c).to_pylist() for c in ("path", "n", "first", "ids")], strict=True):
            if path == current:
                state.update(b",")
                n, first = n + count, min(first, least)
            else:
                if state:
                    done.append((current, n, first, state.hexdigest()))
                current, state, n, first = path, hashlib.sha256(), count, least
            state.update(ids.encode())
        yield row_batch(done)
    if state:
        yield row_batch([(current, n, first, state.hexdigest())])


def distinct_paths(members: DataFrame) -> DataFrame:
    """Each path with its number of conversations, the smallest and the hash of all their ids:
    path, n, first, ends. `members` has a unique `conv_id` and a `path`.

    Ids are listed in blocks of the number line, so that no row grows with a path's members;
    the blocks of one path are then hashed in order as they stream by.
    """
    blocks = members.groupBy("path", F.expr(f"conv_id div {ID_BLOCK}").alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("first"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    ordered = blocks.repartition("path").sortWithinPartitions("path", "block")
    return ordered.mapInArrow(_hash_ids, "path binary, n bigint, first bigint, ends string")


def splitters_of(paths: DataFrame, shards: int, most_turns: int = MOST_TURNS) -> list[bytes]:
    """Up to `shards` - 1 paths, cut to `most_turns`, that deal the written `paths` evenly."""
    rows = paths.count()
    wanted = shards * SAMPLED
    picked = paths.select(F.substring("path", 1, most_turns * RECORD).alias("path"))
    if rows > wanted:
        picked = picked.filter(F.pmod(F.xxhash64("path"), F.lit(1 << 32)) < int(wanted / rows * (1 << 32)))
    held = sorted(row.path for row in picked.distinct().collect())  # about `wanted` rows
    step = max(1, len(held) // shards)
    return [bytes(path) for path in held[step::step][: shards - 1] if path]


def common_turns(a: bytes, b: bytes) -> int:
    """Leading records that two paths share."""
    most = min(len(a), len(b)) // RECORD
    low = 0
    while low < most and a[low * RECORD : (low + 1) * RECORD] == b[low * RECORD : (low + 1) * RECORD]:
        low += 1
    return low


def _neighbours(splitters: list[bytes], path: bytes) -> list[bytes]:
    at = bisect_left(splitters, path)
    return splitters[max(0, at - 1) : at + 2]


def skeleton_turns(splitters: list[bytes], path: bytes) -> int:
    """Depth to which a path runs along the skeleton."""
    return max((common_turns(path, s) for s in _neighbours(splitters, path)), default=0)


def _into_shards(splitters: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(splitters, path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    return run


@dataclass(slots=True)
class _Open:
    """A node whose members still stream by; `closed` are finished children that wait for the
    node's smallest member."""

    size: int
    on_skeleton: bool
    n: int = 0
    first: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None
    closed: list[list] = field(default_factory=list)

    def add(self, n: int, first: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(self.first, first)


NODE = (
    "prefix binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, size bigint, inner boolean"
)
_KINDS = (pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.int64(), pa.bool_())
_NAMES = [part.split()[0] for part in NODE.split(", ")]


def _walk(splitters: list[bytes]):
    """Distinct paths sorted by shard and path -> nodes. A finished node has no prefix; it has
    its parent's id, or the prefix of a parent on the skeleton. A partial skeleton node has
    its prefix; its sums leave out its children on the skeleton, but for n_convs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        last, shard = b"", None
        out: list[list] = []

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                node, depth = stack.pop(), len(stack)
                above = stack[-1] if stack else None
                if above:
                    above.add(node.n, node.first)
                prefix = last[: depth * RECORD]
                if node.on_skeleton:
                    inner = any(s != prefix and s.startswith(prefix) for s in _neighbours(splitters, prefix))
                    out.append([prefix, None, node.first, depth, None, node.n, node.children, node.leaves, node.saved, node.ends, node.size, inner])
                    continue
                leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
                row = [None, None, node.first, depth, None, node.n, node.children, leaves, saved, node.ends or NOBODY, None, None]
                for child in node.closed:
                    child[4] = node.first
                out.extend(node.closed)
                above.children += 1
                above.leaves += leaves
                above.saved += saved
                if above.on_skeleton:
                    row[1] = prefix[:-RECORD]
                    out.append(row)
                else:
                    above.closed.append(row)

        def taken() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(_KINDS)], _NAMES)
            out.clear()
            return batch

        for batch in batches:
            for own, path, n, first, ends in zip(*[batch.column(c).to_pylist() for c in ("shard", "path", "n", "first", "ends")], strict=True):
                if own != shard:
                    close(0)
                    shard, last = own, b""
                    stack.append(_Open(0, True))
                shared = common_turns(last, path)
                close(shared + 1)
                known = skeleton_turns(splitters, path)
                last = path
                for depth in range(shared + 1, len(path) // RECORD + 1):
                    size = int.from_bytes(path[depth * RECORD - LENGTH_BYTES : depth * RECORD], "big")
                    stack.append(_Open(size, depth <= known))
                stack[-1].add(n, first)
                stack[-1].ends = ends
            yield taken()
        close(0)
        yield taken()

    return run


def _reduced(partials: DataFrame) -> DataFrame:
    """Skeleton nodes, whole: prefix and the columns of the result but the parent.

    Partials are summed by node; then every node adds what is below it off the skeleton, and
    itself, to all nodes above it on the skeleton.
    """
    nodes = partials.groupBy("prefix", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
        F.max("size").alias("size"),
        F.max("inner").alias("inner"),
    )
    leaf = (F.col("n_children") == 0) & ~F.col("inner")
    up = nodes.select(
        "*",
        (F.col("n_leaves") + leaf.cast("bigint")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("depth"))).alias("at"),
    )
    itself = F.col("at") == F.col("depth")
    child = F.col("at") == F.col("depth") - 1
    return up.groupBy(F.substring("prefix", F.lit(1), (F.col("at") * RECORD).cast("int")).alias("prefix"), F.col("at").alias("depth")).agg(
        *[F.max(F.when(itself, F.col(c))).alias(c) for c in ("conv_id", "n_convs")],
        (F.max(F.when(itself, F.col("n_children"))) + F.count_if(child)).alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max(F.when(itself, F.col("ends_sha256"))), F.lit(NOBODY)).alias("ends_sha256"),
    )


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(members: DataFrame, shards: int | None = None, most_turns: int = MOST_TURNS) -> DataFrame:
    """Every node of the trie of `members` (unique `conv_id`, `path` as of `turn_paths`):

    * conv_id, depth: its smallest member and its turns; together they name a node
    * parent_conv_id: the smallest member of the node above, null for the root
    * n_convs, n_children: conversations that start with it, nodes one turn longer
    * n_leaves: childless nodes of its subtree, itself included
    * saved_tokens: over its subtree, (n_convs - 1) times the code points of the last text
    * ends_sha256: of the ids, ascending and comma-joined, of conversations that end here

    No members give no nodes, not even a root. Conversations without turns end at the root.
    `shards` is the session's number of shuffle partitions if not given, at most 4,096. Paths
    that share more than `most_turns` turns stay in one shard, which streams them.
    """
    spark = members.sparkSession
    shards = min(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_SHARDS)
    paths = materialize(distinct_paths(members), "paths")
    splitters = splitters_of(paths, shards, most_turns)
    sharded = paths.mapInArrow(_into_shards(splitters), "shard int, path binary, n bigint, first bigint, ends string")
    ordered = sharded.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path")
    nodes = materialize(ordered.mapInArrow(_walk(splitters), NODE), "nodes")

    skeleton = materialize(_reduced(nodes.filter("prefix IS NOT NULL")), "skeleton")
    above = skeleton.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("above_id"))
    finished = nodes.filter("prefix IS NULL")
    inside = finished.filter("parent IS NULL").select(*RESULT)
    top = finished.filter("parent IS NOT NULL").join(above, "parent").withColumn("parent_conv_id", F.col("above_id"))
    cut = F.when(F.col("depth") > 0, F.substring("prefix", F.lit(1), ((F.col("depth") - 1) * RECORD).cast("int")))
    bones = skeleton.withColumn("parent", cut).join(above, "parent", "left").withColumn("parent_conv_id", F.col("above_id"))
    return inside.unionAll(top.select(*RESULT)).unionAll(bones.select(*RESULT))
