"""Sets of hashed word shingles of whole texts, computed over the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows in order, and where each row's words begin (one entry more than rows).

    Words are runs of bytes outside ASCII white space, A-Z lower-cased. Null rows have none.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:last]
    offsets = offsets - first
    inside = ~_WHITE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)  # no word goes past the end of a row
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(column) + 1, dtype=np.int64)
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _STEP, dtype=np.uint64))
    hashes = np.add.reduceat(_BYTE[_LOWER[data[inside]]] * powers[within], begins)
    rows = np.searchsorted(starts, offsets)
    return mixed(hashes + lengths.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), rows


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of five words; of all its words if it has fewer."""
    words, rows = word_hashes(column)
    weights = np.cumprod(np.full(WIDTH, 0xE7037ED1A0B428DB, dtype=np.uint64))
    joined = np.zeros(max(0, len(words) - WIDTH + 1), dtype=np.uint64)
    for at in range(WIDTH):
        joined += words[at : at + len(joined)] * weights[at]
    joined = mixed(joined)
    sets = []
    for begin, end in zip(rows[:-1], rows[1:]):
        n = end - begin
        if n >= WIDTH:
            sets.append(np.unique(joined[begin : end - WIDTH + 1]))
        elif n:
            sets.append(mixed((words[begin:end] * weights[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            sets.append(words[:0])
    return sets
