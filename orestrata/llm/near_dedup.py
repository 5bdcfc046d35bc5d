"""Near-duplicate groups by SuperMinHash, banding, verification and component grouping.

1. One pass over the texts: the set of shingles of each document, its SuperMinHash
   signature and the hashes of the signature's bands. Documents of equal sets are one
   class from here on, as 128 bits of a hash of their sets tell.
2. Classes that share a band are compared by their whole signatures; those whose estimated
   similarity may reach the threshold are linked into families.
3. Within each family the full sets are compared, exactly. These links make the components.

Only a pair that shares no band, or whose estimate is far off, could be missed: bands and
the least estimate are chosen by the threshold so that at most one in a million of pairs at
it is, fewer above it, and only where no third document connects the two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import ceil, exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orestrata.llm.links import Kernel, components, spanning_links
from orestrata.llm.words import WordHashes, mix, shingle_sets, word_slices
from orestrata.sources.scratch import materialize

# Members of a cell compared by signature, all of one size; bytes of one compared by set, and
# what a set counts for at least, which bounds the members too.
SIGNATURE_CELL = 1024
SET_CELL = 16 << 20
LEAST_WEIGHT = 16 << 10
# Signature places, rows of a band at most, and which share of the pairs at the threshold at
# most may share no band, or have too low an estimate.
PLACES = 192
LONGEST_BAND = 6
MISSES = 5e-7
# Words of 64 bits that tell which texts may be wanted: a million texts set 6 % of the bits.
FILTER_WORDS = 1 << 18

_STEP = np.uint64(0xD6E8FEB86659FD93)
_WORD = (1 << 64) - 1


@dataclass(frozen=True)
class Banding:
    """`bands` bands of `rows` signature places each."""

    bands: int
    rows: int

    @property
    def places(self) -> int:
        return self.bands * self.rows


def banding_for(percent: int) -> Banding:
    """The longest bands of PLACES places that miss at most MISSES of the pairs at the
    threshold; if none do, as many places as one row a band takes."""
    level = percent / 100
    for rows in range(LONGEST_BAND, 0, -1):
        if (1 - level**rows) ** (PLACES // rows) <= MISSES:
            return Banding(PLACES // rows, rows)
    return Banding(ceil(log(MISSES) / log1p(-level)), 1)


def least_estimate(percent: int, places: int) -> float:
    """The highest share of equal places that at most MISSES of the pairs at the threshold fall
    short of, places being independent; those of SuperMinHash vary less."""
    if percent >= 100:
        return 1.0
    level, below, equal = percent / 100, 0.0, -1
    while below <= MISSES:
        equal += 1
        ways = lgamma(places + 1) - lgamma(equal + 1) - lgamma(places - equal + 1)
        below += exp(ways + equal * log(level) + (places - equal) * log1p(-level))
    return (equal - 0.5) / places if equal else 0.0


def superminhash(elements: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash signatures of sets that lie in a line: one row of `places` per set.

    Each element goes through the places in its own random order; in step j it offers the
    place j plus a random fraction, here (j << 32) + 32 random bits, and a place keeps its
    smallest offer. Later offers are larger, so a set whose places are all below the next
    step is done: a set of many elements after one step or two.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    signatures = np.full(len(counts) * places, np.iinfo(np.uint64).max, np.uint64)
    order = None
    for step in range(places):
        if not len(elements):
            break
        random = mix(elements + np.uint64((step + 1) * int(_STEP) & _WORD))
        pick = (step + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(places - step)) >> np.uint64(32))).astype(np.int64)
        if order is None:
            place = pick
        else:
            at = np.arange(len(elements))
            place = order[at, pick].astype(np.int64)
            order[at, pick] = order[:, step]
        offer = (np.uint64(step) << np.uint64(32)) | (random >> np.uint64(32))
        np.minimum.at(signatures, owner * places + place, offer)
        open_sets = signatures.reshape(-1, places).max(axis=1) >= np.uint64(step + 1) << np.uint64(32)
        going = open_sets[owner]
        if order is None:
            if not going.any():
                break
            order = np.tile(np.arange(places, dtype=np.uint16), (int(going.sum()), 1))
            order[np.arange(len(order)), pick[going]] = 0
        else:
            order = order[going]
        elements, owner = elements[going], owner[going]
    return signatures.reshape(-1, places)


def band_hashes(signatures: np.ndarray, banding: Banding) -> np.ndarray:
    """One hash per set and band."""
    value = np.arange(banding.bands, dtype=np.uint64) * _STEP + np.zeros((len(signatures), 1), np.uint64)
    parts = signatures.reshape(len(signatures), banding.bands, banding.rows)
    for i in range(banding.rows):
        value = mix((value ^ parts[:, :, i]) + _STEP)
    return value


def _set_id(elements: np.ndarray) -> tuple[int, int]:
    """128 bits in two words."""
    digest = blake2b(elements.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


_FEATURES = (
    "doc_id bigint, text_hash bigint, n_shingles bigint, set_id bigint, set_check bigint, bands array<bigint>, signature binary"
)


def _featurize(length: int, banding: Banding):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for first, words, counts in word_slices(batch.column("text"), hashes):
                own = batch.select(["doc_id", "text_hash"]).slice(first, len(counts))
                yield features(own, shingle_sets(words, counts, length))

    def features(own: pa.RecordBatch, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets])
        signatures = superminhash(np.concatenate(sets), sizes, banding.places)
        bands = band_hashes(signatures, banding).view(np.int64)
        short = signatures.astype(np.uint8)
        empty = sizes == 0
        known = [_set_id(s) if len(s) else (None, None) for s in sets]
        columns = [
            own.column("doc_id").cast(pa.int64()),
            own.column("text_hash"),
            pa.array(sizes, pa.int64()),
            *[pa.array([pair[i] for pair in known], pa.int64()) for i in (0, 1)],
            pa.array([None if none else row for none, row in zip(empty, bands, strict=True)], pa.list_(pa.int64())),
            pa.array([None if none else row.tobytes() for none, row in zip(empty, short, strict=True)], pa.binary()),
        ]
        names = ["doc_id", "text_hash", "n_shingles", "set_id", "set_check", "bands", "signature"]
        return pa.RecordBatch.from_arrays(columns, names)

    return run


def _sets(length: int):
    """The sets that were asked for: rows (id, set_id, set_check, text) -> (id, payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for first, words, counts in word_slices(batch.column("text"), hashes):
                asked = [batch.column(name).slice(first, len(counts)).to_pylist() for name in ("id", "set_id", "set_check")]
                rows = zip(*asked, shingle_sets(words, counts, length), strict=True)
                found = [(i, s.tobytes()) for i, *pair, s in rows if _set_id(s) == tuple(pair)]
                columns = [pa.array([i for i, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "payload"])

    return run


def by_signature(least: float) -> Kernel:
    """Links of signatures that agree in at least the share `least` of their places."""

    def kernel(payloads: list[bytes]):
        signatures = np.frombuffer(b"".join(payloads), np.uint8).reshape(len(payloads), -1)
        need = least * signatures.shape[1]
        return lambda one, others: (signatures[others] == signatures[one]).sum(axis=1) >= need

    return kernel


def by_set(percent: int) -> Kernel:
    """Links of sets with 100 x intersection >= percent x union."""

    def kernel(payloads: list[bytes]):
        sizes = np.array([len(p) // 8 for p in payloads])
        values, flat = np.unique(np.frombuffer(b"".join(payloads), np.uint64), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        marked = np.zeros(len(values), bool)

        def linked(one: int, others: np.ndarray) -> np.ndarray:
            own = flat[starts[one] : ends[one]]
            marked[own] = True
            common = np.add.reduceat(marked[flat], starts, dtype=np.int64)[others]
            marked[own] = False
            return 100 * common >= percent * (sizes[others] + sizes[one] - common)

        return linked

    return kernel


def with_class_ids(features: DataFrame) -> DataFrame:
    """`features` with the `id` of their class: the first word of the set's hash, or, where
    sets share that and differ in the second word, a hash of both."""
    words = features.groupBy("set_id").agg(F.min("set_check").alias("least"), F.max("set_check").alias("most"))
    shared = materialize(words.filter("least <> most").select(F.col("set_id").alias("shared_id")), "shared")
    both = F.when(F.col("shared_id").isNotNull(), F.xxhash64("set_id", "set_check")).otherwise(F.col("set_id"))
    return features.join(shared, F.col("set_id") == F.col("shared_id"), "left").withColumn("id", both).drop("shared_id")


def may_have(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """`rows` without most of those whose key is not in `wanted`, and with all whose key is.

    Each key sets one of 64 * `FILTER_WORDS` bits, which every task gets, so that rows need not
    be shuffled to be told from the wanted ones. Where most bits are set, more rows pass.
    """
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    word, bit = F.shiftright(place, 6), F.pmod(place, F.lit(64)).cast("int")
    bits = F.expr("bit_or(shiftleft(1L, bit))").alias("bits")
    words = wanted.select(word.alias("word"), bit.alias("bit")).distinct().groupBy("word").agg(bits)
    return rows.join(F.broadcast(words), (word == F.col("word")) & (F.getbit("bits", bit) == 1)).select(*rows.columns)


def near_duplicates(
    docs: DataFrame, *, shingle_words: int = 5, percent: int = 80, banding: Banding | None = None
) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64), n_shingles, component_id, kept.

    Two documents are linked when 100 x the size of the intersection of their shingle sets
    is at least `percent` x that of the union. `component_id` is the smallest doc_id that
    links reach, `kept` marks the document that carries it.

    Text with fewer words than a shingle is one shingle. Null, empty or blank text has no
    set and is linked with nothing, and so is a row without doc_id, whose component_id is
    null and which is kept. Rows that repeat a doc_id are judged each by its own text;
    exact repetitions agree, so all of them carry `kept`. Other columns are ignored. Texts
    of any length count whole. An empty table gives an empty result.

    Writes to the shared folder.
    """
    banding = banding or banding_for(percent)
    slim = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    features = materialize(slim.mapInArrow(_featurize(shingle_words, banding), _FEATURES), "features")
    known = with_class_ids(features).filter("id IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("id").agg(
        *[F.min(c).alias(c) for c in ("doc_id", "n_shingles", "set_id", "set_check")],
        F.first("bands").alias("bands"),
        F.first("signature").alias("payload"),
    )
    classes = materialize(classes, "classes")

    buckets = classes.select(F.explode("bands").alias("group"), "id", F.lit(1).alias("weight"))
    similar = spanning_links(buckets, classes.select("id", "payload"), by_signature(least_estimate(percent, banding.places)), SIGNATURE_CELL)
    family = materialize(components(similar), "families")
    roots = family.select(F.col("component").alias("group"), F.col("component").alias("id")).distinct()
    members = family.select(F.col("component").alias("group"), "id").unionAll(roots)
    members = members.join(classes.drop("bands", "payload"), "id")
    members = materialize(members.withColumn("weight", F.greatest(8 * F.col("n_shingles"), F.lit(LEAST_WEIGHT))), "members")

    wanted = members.select("id", "doc_id", "set_id", "set_check")
    texts = may_have(docs.select(F.col("doc_id").cast("bigint"), "text"), wanted, "doc_id")
    sets = texts.join(wanted, "doc_id").select("id", "set_id", "set_check", "text")
    sets = sets.mapInArrow(_sets(shingle_words), "id bigint, payload binary").dropDuplicates(["id"])
    exact = components(spanning_links(members.select("group", "id", "weight"), sets, by_set(percent), SET_CELL))

    labels = classes.select("id", "doc_id", "set_id", "set_check").join(exact, "id", "left")
    labels = labels.withColumn("component", F.coalesce("component", "id"))
    least_id = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = labels.join(least_id, "component").select("set_id", "set_check", "component_id")
    result = features.select("doc_id", "text_hash", "n_shingles", "set_id", "set_check").join(named, ["set_id", "set_check"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "text_hash", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
