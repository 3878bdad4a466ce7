"""Words and shingles of many texts at once, as 64-bit hashes in numpy.

A word is ``[^\\x20\\x09-\\x0D]+``; its letters A-Z count as a-z. White space is single bytes in
UTF-8, so all of this works on the bytes of an Arrow column without decoding it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
#: Bytes of text handled at a time; what a step holds is a small multiple of it.
SLICE = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_seeded = np.random.default_rng(20240229)
_BYTE = _seeded.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _seeded.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.array([0x9E3779B97F4A7C15], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE[0], np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def release() -> None:
    """Give unused memory back to the system: a Python worker stays from stage to stage, beside others on its machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def small(batches: Iterator, rows: int = 512) -> Iterator:
    """The Arrow ``batches`` in runs of a few rows, so that few texts are Python strings at a time. What earlier tasks and
    batches left behind is released."""
    release()
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
        release()


def text_slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them) for runs of rows of about SLICE bytes. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and for each row the number of words before it (one more entry than rows)."""
    solid = ~_SPACE[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    opens[inner] = solid[inner]  # a row begins a new word
    starts = np.flatnonzero(opens)
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    at = np.flatnonzero(solid)
    first = np.searchsorted(at, starts)
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    value = _BYTE[_LOWER[data[at]]] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64)), before


def shingle_sets(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """For each row the sorted hashes of its distinct five-word shingles. A row with one to four words has its whole
    sequence as the only one; a row without words has none."""
    for _, data, offsets in text_slices(column):
        words, before = word_hashes(data, offsets)
        n = len(words) - SHINGLE + 1
        windows = np.zeros(0, np.uint64)
        if n > 0:
            windows = words[:n] * _PLACE[0]
            for k in range(1, SHINGLE):
                windows += words[k:k + n] * _PLACE[k]
            windows = mix(windows)
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                own = np.sort(windows[a:b - SHINGLE + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif b > a:
                yield mix((words[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True) + _BASE * np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
