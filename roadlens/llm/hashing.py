"""Runs of bytes in Arrow text columns, and 64-bit hashes of them, without a Python string each."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_K = np.uint64(0x9E3779B97F4A7C15)  # odd constants of the usual 64-bit finalisers
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)
_LONG = 64  # longer runs are hashed one by one

# The characters that end a word.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and the offsets of the texts (null: empty)."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; equal bytes have equal hashes wherever they stand."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    lengths = ends - starts
    hashes = mixed(lengths.astype(np.uint64) + np.uint64(seed) * _K + _K)
    active = np.flatnonzero((lengths > 0) & (lengths <= _LONG))
    at, left = starts[active], lengths[active]
    value = hashes[active]
    while len(active):
        piece = eights[at].copy().view(np.uint64).ravel() & _MASKS[np.minimum(left, 8)]
        value = mixed(value ^ piece) * _K
        hashes[active] = value
        more = np.flatnonzero(left > 8)
        active, at, left, value = active[more], at[more] + 8, left[more] - 8, value[more]
    for i in np.flatnonzero(lengths > _LONG):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=seed)
    return hashes


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of marked bytes, and where the runs of each text begin in these lists.

    A run never crosses the end of a text.
    """
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]  # first bytes of texts
    first[edges] = inside[edges]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``runs`` of bytes that are no blanks."""
    return runs(~BLANK[data], offsets)


def blocks(batch: pa.RecordBatch, column: int, most: int):
    """Consecutive slices of a batch with about ``most`` bytes of text (one text at least)."""
    texts = batch.column(column)
    sizes = np.frombuffer(texts.cast(pa.large_string()).buffers()[1], np.int64)
    sizes = np.diff(sizes[texts.offset : texts.offset + len(texts) + 1])
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)
