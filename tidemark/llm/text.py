"""Whole Arrow text columns as byte arrays: words, and hashes of words and of runs of words.

Nothing here turns a text into Python strings. A hash of a run is a polynomial over 64-bit values, read off one running
sum, so hashing every run of a length costs a few array passes whatever the length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # text bytes handled at once; one longer text is a slice of its own
_ROOT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership table of the bytes in the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Every byte but space and 0x09 to 0x0D is part of a word.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: ASCII letters, digits and every byte of a character beyond ASCII.
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z made a-z, all other bytes kept."""
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts (one entry more than texts); a null is an empty text."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of a batch with at most ``limit`` text bytes (or one row), with their bytes and offsets."""
    data, offsets = text_bytes(column(batch, name))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield batch.slice(first, last - first), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = 1 << (n - 1).bit_length()
        _powers, _inverses = np.full(n, _ROOT), np.full(n, _INVERSE)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)


class Runs:
    """Hashes of runs of a sequence of 64-bit values: equal runs have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray):
        _grow(len(values) + 1)
        self.n = len(values)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * _powers[:self.n], out=self.sums[1:])

    def between(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * _inverses[first])

    def every(self, length: int) -> np.ndarray:
        """The hash of the run of this length at every place that has one."""
        m = max(0, self.n - length + 1)
        return mix((self.sums[length:length + m] - self.sums[:m]) * _inverses[:m])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


class Words:
    """The words of several texts: first and end byte, hash, and where each text's words start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, members: np.ndarray, lower: bool = False):
        self.data = lowered(data) if lower else data
        inside = members[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = np.flatnonzero(np.diff(offsets))
        starts[offsets[full]] = inside[offsets[full]]
        ends[offsets[full + 1] - 1] = inside[offsets[full + 1] - 1]
        self.first, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.offsets = np.searchsorted(self.first, offsets)

    def hashes(self) -> np.ndarray:
        return Runs(byte_values(self.data)).between(self.first, self.end)


def doc_of(offsets: np.ndarray) -> np.ndarray:
    """The text number of every unit."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def room(offsets: np.ndarray, length: int) -> np.ndarray:
    """Whether a run of this length fits in its text, for every unit as its first."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(len(ends)) + length <= ends


def pack(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Consecutive parts of an array as binary cells; bounds: first index of each part, and the end."""
    values = np.ascontiguousarray(values)
    offsets = np.asarray(bounds, np.int64) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def unpack(cells, dtype) -> np.ndarray:
    """Binary cells as one array."""
    return np.frombuffer(b"".join(cells), dtype)
