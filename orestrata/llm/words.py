"""Words, shingles and their hashes, for the operators that compute in Arrow batches.

A word is a run of characters other than space and the five ASCII control blanks, with
A-Z lower-cased; `bytes.split` and `bytes.lower` do just that to UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

# Words whose hash a Python worker remembers, and words hashed in one go.
REMEMBERED = 400_000
SLICE_WORDS = 100_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word, computed when first asked for. Forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


def texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def word_slices(column: pa.Array, hashes: WordHashes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes of some rows in a line, words of each row), whole rows only.

    A null text has no words.
    """
    flat: list[int] = []
    counts: list[int] = []
    first = 0
    for row, text in enumerate(texts(column)):
        words = (text or b"").lower().split()
        if flat and len(flat) + len(words) > SLICE_WORDS:
            yield first, np.array(flat, np.uint64), np.array(counts)
            flat, counts, first = [], [], row
        flat.extend(map(hashes.__getitem__, words))
        counts.append(len(words))
    if counts:
        yield first, np.array(flat, np.uint64), np.array(counts)


def chained(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every `length` words in a row."""
    size = max(0, len(words) - length + 1)
    value = np.full(size, length, np.uint64) * _GOLDEN
    for i in range(length):
        value = mix((value ^ words[i : i + size]) + _GOLDEN)
    return value


def shingle_sets(words: np.ndarray, counts: np.ndarray, length: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer words than `length` are one
    shingle, none are an empty set."""
    value = chained(words, length)
    sets = []
    end = 0
    for count in counts:
        start, end = end, end + count
        if count >= length:
            sets.append(np.unique(value[start : end - length + 1]))
        else:
            sets.append(chained(words[start:end], count) if count else np.empty(0, np.uint64))
    return sets
