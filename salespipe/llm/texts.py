"""Vectorised helpers on whole texts: bytes, words and hashes of an Arrow batch.

Every function works on all bytes of all texts it is given. ``slices`` cuts a
batch of rows into runs of whole documents of about a megabyte, so the arrays
stay small whatever the size of a batch; a longer document is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

# The bytes that separate words, as in [^\x20\x09-\x0D]+.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93


def _wordlike() -> np.ndarray:
    table = np.ones(256, bool)
    table[list(SEPARATORS)] = False
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


WORD = _wordlike()
LOWER = _lower()
BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least the first n powers of the base and of its inverse."""

    def up(base: int) -> np.ndarray:
        out = np.full(1 << n.bit_length(), base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [up(_BASE), up(pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def rolling(data: np.ndarray, table: np.ndarray = BYTE_VALUES) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which any byte range is hashed: ``(total[end] - total[start]) * inverse[start]``."""
    powers, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * powers[: len(data)], out=total[1:])
    return total, inverse


class Slice:
    """Some whole documents as one byte array; ``at[i]:at[i + 1]`` are those of document ``first + i``."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray) -> None:
        self.first, self.data, self.at = first, data, at
        self.n = len(at) - 1

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum of one value per byte over each document."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of each maximal run of marked bytes; runs end with their document."""
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        before[self.at] = False
        starts = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        after[self.at] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        return starts, ends, np.searchsorted(self.at, starts, "right") - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.runs(WORD[self.data])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of each byte range; ``fold`` reads A-Z as a-z."""
        total, inverse = rolling(self.data, BYTE_VALUES[LOWER] if fold else BYTE_VALUES)
        return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def plain(column: pa.Array) -> pa.Array:
    """A text column with NULL as the empty text and wide offsets."""
    return column.cast(pa.large_string()).fill_null("")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    column = plain(column)
    if not len(column):
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield Slice(first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def shingles(words: np.ndarray, docs: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each run of ``size`` words; a shorter document is one shingle of all its words."""
    counts = np.bincount(docs, minlength=n)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    full = np.maximum(counts - size + 1, 0)
    owner = np.repeat(np.arange(n), full)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full) + firsts[owner]
    hashed = np.zeros(len(start), np.uint64)
    for k in range(size):
        hashed = mix(hashed * _ODD + words[start + k])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        tail = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            on = counts[short] > k
            tail[on] = mix(tail[on] * _ODD + words[firsts[short[on]] + k])
        tail = mix(tail + counts[short].astype(np.uint64) * np.uint64(_BASE))
        hashed, owner = np.concatenate((hashed, tail)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        hashed, owner = hashed[order], owner[order]
    return hashed, owner


def distinct(hashed: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each document, ascending within it."""
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[new], owner[new]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def counted(docs, name: str):
    """``docs`` with the number of words of each whole text; a column of that name is replaced."""
    kept = [c for c in docs.columns if c != name]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(column(batch, "text").cast(pa.large_string())):
                words = np.bincount(part.words()[2], minlength=part.n)
                yield pa.RecordBatch.from_arrays([*batch.slice(part.first, part.n).columns, pa.array(words)], [*kept, name])

    rows = docs.select(*kept)
    return rows.mapInArrow(count, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))
