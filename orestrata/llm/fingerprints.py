"""Document fingerprints: Merkle trees over sentences, paragraphs and sections.

A paragraph is a line, a section the lines up to a blank one, and the leaves are a few
sentences, or pieces of a long one, whatever its script and with or without blanks. A leaf
ends after a sentence that its own hash picks, or after a character that the hash of the last
few picks, so an edit moves only the ends near it; no leaf is longer than LONGEST_LEAF. Each
node's hash covers its children's.

A fingerprint is the tree as text: the root, then sections of paragraphs of leaves, of whose
hashes the first 64 bits are written. Equal roots mean equal texts. Comparing two trees goes down only where hashes differ: whole
sections, then whole paragraphs, then leaves are matched, and what stays unmatched locates
the edits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.llm.words import mix
from orestrata.sources.scratch import scratch_path

# One in so many sentences ends a leaf that is long enough. A sentence of more than LONG_SENTENCE characters is
# cut inside: after one in CHARACTERS characters, as the last WINDOW of them tell.
SENTENCES = 2
LONG_SENTENCE = 192
CHARACTERS = 96
WINDOW = 8
SHORTEST_LEAF = 48
LONGEST_LEAF = 512
WRITTEN = 16
_SENTENCE = re.compile(r"[^.!?\u2026\u3002\uff01\uff1f\uff0e]*[.!?\u2026\u3002\uff01\uff1f\uff0e]+\s*|[^.!?\u2026\u3002\uff01\uff1f\uff0e]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

# Paragraph: hash, characters, ((leaf hash, characters), ...). Section: hash, characters, paragraphs.
Leaf = tuple[str, int]
Node = tuple[str, int, tuple]


def _hash(data: str) -> str:
    return blake2b(data.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _ends(piece: str) -> bool:
    return crc32(piece.strip().encode("utf-8", "surrogatepass")) % SENTENCES == 0


def _cut(sentence: str) -> Iterator[str]:
    """Pieces of a long sentence, of SHORTEST_LEAF (but for the last) to LONGEST_LEAF
    characters."""
    codes = mix(np.frombuffer(sentence.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64))
    rolled = codes.copy()
    for _ in range(WINDOW - 1):
        rolled[1:] = rolled[:-1] * _FACTOR + codes[1:]
    at = 0
    for end in np.flatnonzero((rolled >> np.uint64(40)) % np.uint64(CHARACTERS) == 0) + 1:
        while end - at > LONGEST_LEAF:
            yield sentence[at : at + LONGEST_LEAF]
            at += LONGEST_LEAF
        if end - at >= SHORTEST_LEAF:
            yield sentence[at:end]
            at = end
    for start in range(at, len(sentence), LONGEST_LEAF):
        yield sentence[start : start + LONGEST_LEAF]


def _leaves(paragraph: str) -> Iterator[str]:
    leaf, size = [], 0
    for sentence in _SENTENCE.findall(paragraph):
        long = len(sentence) > LONG_SENTENCE
        if leaf and (long or size + len(sentence) > LONGEST_LEAF):
            yield "".join(leaf)
            leaf, size = [], 0
        if long:
            yield from _cut(sentence)
            continue
        leaf.append(sentence)
        size += len(sentence)
        if size >= SHORTEST_LEAF and _ends(sentence):
            yield "".join(leaf)
            leaf, size = [], 0
    if leaf:
        yield "".join(leaf)


def _node(children: list) -> Node:
    return _hash("".join(child[0] for child in children)), sum(child[1] for child in children), tuple(children)


def tree(text: str) -> tuple[str, tuple[Node, ...]]:
    """The root's hash, and the sections. Joined, the leaves give the text back; where it is cut
    depends on the text alone, so equal texts have equal trees."""
    sections: list[Node] = []
    paragraphs: list[Node] = []
    for line in text.splitlines(keepends=True):
        paragraphs.append(_node([(_hash(leaf), len(leaf)) for leaf in _leaves(line)]))
        if not line.strip():
            sections.append(_node(paragraphs))
            paragraphs = []
    if paragraphs:
        sections.append(_node(paragraphs))
    return _hash("".join(s[0] for s in sections)), tuple(sections)


def serialize(root: str, sections: tuple[Node, ...]) -> str:
    """`root|section;section`, a section being its paragraphs joined by `,` and a paragraph
    its leaves, `hash:characters`, joined by `.`. Of leaves' hashes the first WRITTEN digits
    are given."""

    def paragraph(node: Node) -> str:
        return ".".join(f"{leaf[0][:WRITTEN]}:{leaf[1]}" for leaf in node[2])

    return f"{root}|" + ";".join(",".join(map(paragraph, section[2])) for section in sections)


def deserialize(fingerprint: str) -> tuple[str, tuple[Node, ...]]:
    root, _, rest = fingerprint.partition("|")
    sections = []
    for section in rest.split(";") if rest else []:
        paragraphs = []
        for paragraph in section.split(","):
            leaves = [leaf.split(":") for leaf in paragraph.split(".")]
            paragraphs.append(_node([(digest, int(size)) for digest, size in leaves]))
        sections.append(_node(paragraphs))
    return root, tuple(sections)


def _match(left: list[Node], right: list[Node]) -> tuple[int, list, list]:
    """Characters of nodes on both sides, each matched once, and the children of the others."""
    there = Counter(node[0] for node in right)
    common, apart = 0, []
    for node in left:
        if there[node[0]] > 0:
            there[node[0]] -= 1
            common += node[1]
        else:
            apart.append(node)
    rest = []
    for node in reversed(right):
        if there[node[0]] > 0:
            there[node[0]] -= 1
            rest.append(node)
    return common, apart, rest[::-1]


def likeness(one: tuple[str, tuple], other: tuple[str, tuple]) -> float:
    """Share of the characters of both texts that lie in matched branches, from 0 to 1; two
    empty texts are alike."""
    if one[0] == other[0]:
        return 1.0
    total = sum(node[1] for node in (*one[1], *other[1]))
    common, left, right = _match(list(one[1]), list(other[1]))
    for _ in range(2):
        more, left, right = _match([c for n in left for c in n[2]], [c for n in right for c in n[2]])
        common += more
    return min(1.0, 2 * common / total) if total else 0.0


def compare(one: str, other: str) -> float:
    """Likeness of two fingerprints."""
    return likeness(deserialize(one), deserialize(other))


def edits(one: str, other: str) -> list[tuple[int, int]]:
    """Where the first text differs from the second: (start, end) of its unmatched leaves, in
    code points, neighbours joined."""
    left, right = deserialize(one), deserialize(other)
    if left[0] == right[0]:
        return []
    known = Counter(leaf[0] for section in right[1] for paragraph in section[2] for leaf in paragraph[2])
    spans: list[tuple[int, int]] = []
    at = 0
    for section in left[1]:
        for paragraph in section[2]:
            for digest, size in paragraph[2]:
                if known[digest] > 0:
                    known[digest] -= 1
                elif spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + size)
                else:
                    spans.append((at, at + size))
                at += size
    return spans


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of `text`. Null text counts as empty; all rows and other
    columns are kept. An existing column `name` is an error."""
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            found = pa.array([serialize(*tree(value or "")) for value in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return docs.mapInArrow(run, docs.withColumn(name, F.lit("")).schema)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the start of the following one."""
    size = len(text) // 3
    return text[: len(text) - size] + following[:size]


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_OPEN = ", part int, edge string, text string"


def _finished(doc_id: int | None, text: str, own: tuple, following: str, next_tree: tuple) -> tuple:
    changed = edited(text, following)
    changed_tree = own if changed == text else tree(changed)
    return (
        doc_id,
        len(text),
        sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        serialize(*own),
        serialize(*changed_tree),
        likeness(own, changed_tree),
        likeness(own, next_tree),
    )


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [_TYPES[field.split()[1]] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], _names(schema))


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of one partition: every row but the last is finished with the next one.
    The first and the last are also given as they are, for the partitions beside this one."""
    before = None
    schema = _RESULT + _OPEN
    empty = (None,) * 6
    for batch in batches:
        rows = []
        columns = [batch.column(batch.schema.names.index(n)).to_pylist() for n in ("doc_id", "text", "part")]
        for doc_id, value, part in zip(*columns, strict=True):
            text = value or ""
            own = tree(text)
            if before is None:
                rows.append((doc_id, *empty, part, "first", text))
            else:
                rows.append((*_finished(*before[:3], text, own), part, None, None))
            before = doc_id, text, own, part
            if len(rows) >= 200:
                yield _batch(rows, schema)
                rows = []
        yield _batch(rows, schema)
    if before is not None:
        yield _batch([(before[0], *empty, before[3], "last", before[1])], schema)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last rows of partitions, each with the text that follows."""
    for batch in batches:
        columns = [batch.column(batch.schema.names.index(n)).to_pylist() for n in ("doc_id", "text", "following")]
        for doc_id, text, following in zip(*columns, strict=True):
            yield _batch([_finished(doc_id, text, tree(text), following, tree(following))], _RESULT)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like it is to the edited
    text and to the next document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by as much of the next document's start.
    Documents come by descending doc_id, after the last comes the first; null doc_ids come
    last, ties by text. Null text is empty; a single document is its own next one. Other
    columns are ignored. An empty table gives an empty result.

    The order is made by ranges, so texts are shuffled once; only the first and the last row
    of each range meet the neighbouring ranges. Writes to the shared folder, as ranges are
    drawn anew on every run of a plan.
    """
    slim = docs.select("doc_id", "text")
    order: list[Column] = [F.desc_nulls_last("doc_id"), F.asc_nulls_first("text_hash"), F.asc_nulls_first("text")]
    ranged = slim.withColumn("text_hash", F.xxhash64("text")).repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    numbered = ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))
    path = scratch_path(docs.sparkSession, "fingerprints")
    numbered.mapInArrow(_follow, _RESULT + _OPEN).write.option("compression", "zstd").parquet(path)
    found = docs.sparkSession.read.schema(_RESULT + _OPEN).parquet(path)

    # Two rows per range, with their texts.
    edges = found.filter("edge IS NOT NULL").select("doc_id", "part", "edge", "text")
    firsts = edges.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    parts = firsts.select("part")
    by_part = Window.orderBy("part")
    start = F.min("part").over(Window.partitionBy())
    next_part = parts.select("part", F.coalesce(F.lead("part").over(by_part), start).alias("next_part"))
    last = edges.filter("edge = 'last'").join(next_part, "part")
    closed = last.join(firsts.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "following")
    return found.filter("edge IS NULL").select(*_names(_RESULT)).unionAll(closed.mapInArrow(_close, _RESULT))
