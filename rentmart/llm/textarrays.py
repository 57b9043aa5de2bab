"""Whole texts as flat numpy arrays: words, lines and n-grams with 64-bit content hashes, no Python work per word.

A batch of texts is one byte array plus offsets. The hash of any span comes from one prefix sum of a polynomial
with an odd base modulo 2^64 (inverses of the powers exist there), followed by a bit mixer. Equal spans have equal
hashes wherever they stand; different ones collide by chance only (about n^2 / 2^65 for n different spans).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# what a worker frees goes back to the system, so that idle workers of earlier stages stay small
pa.set_memory_pool(pa.system_memory_pool())

BASES = (0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4F & ~7 | 3)  # 3 or 5 modulo 8: small differences keep their rank
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: white space of the contracts: blank and 0x09-0x0D
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """base^0..n-1 and their inverses modulo 2^64."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        base, up, down = BASES[which], np.empty(size, np.uint64), np.empty(size, np.uint64)
        for out, b in ((up, base), (down, pow(base, -1, 1 << 64))):
            out[0], done = 1, 1
            while done < size:  # doubling
                step = min(done, size - done)
                out[done : done + step] = out[:step] * np.uint64(pow(b, done, 1 << 64))
                done += step
        if size > 1 << 23:  # one very long text: not kept
            return up, down
        have = _POWERS[which] = (up, down)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair of ``starts`` and ``ends``; empty spans hash alike."""
    n = len(values)
    up, down = powers(n + 1, which)
    total = np.zeros(n + 1, np.uint64)
    v = values.astype(np.uint64)
    v += np.uint64(1)
    v *= up[:n]
    np.cumsum(v, out=total[1:])
    h = total[ends]
    h -= total[starts]
    h *= down[starts]
    return mix(h)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (one more than texts) of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``max_bytes`` of text; a longer text is a piece of its own, never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > max_bytes:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield batch.slice(at)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every run of non-space bytes, and the index of its first word for each text
    (one more than texts). No word spans two texts."""
    full = ~IS_SPACE[data]
    if not len(full):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1]
    last[:-1] &= ~full[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = full[cuts]
    last[cuts - 1] = full[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ngram_hash(h: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of each ``n`` consecutive values (``len(h) - n + 1`` of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(m)
    return span_hash(h, at, at + n, which)


def spread(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For spans of these lengths laid end to end: the span of each position and the position inside it."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    return owner, np.arange(len(owner)) - begin[owner]
