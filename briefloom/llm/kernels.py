"""Vectorized text kernels shared by the corpus operators.

Everything here works on the raw UTF-8 buffer of an Arrow string column, a few
megabytes at a time, so the memory of a task does not depend on how many rows
its batch holds.  (One document is never split, so the longest document bounds
the chunk from below.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text taken through the numpy kernels at once.
CHUNK_BYTES = 2 << 20

_RNG = np.random.default_rng(20240917)
_BYTE_KEY = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: White space of the word definition [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Word bytes of the class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (text lower-cased before).
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, n at least."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        out = []
        for base in (_BASE, _BASE_INV):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers = (out[0], out[1])
    return _powers


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences are position-weighted hashes of substrings."""
    pw = powers(len(data) + 1)[0]
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_KEY[data] * pw[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end) of a prefix-hashed buffer."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]
    return mix(raw ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    large = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.null_count:
        column = pc.fill_null(column.cast(large), b"" if large == pa.large_binary() else "")
    else:
        column = column.cast(large)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) with about ``most`` bytes each."""
    raw, off = buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + most, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` bytes that stay in one document.

    Returns starts, ends, the document of each word, and the number of words of
    each document.
    """
    n, docs = len(data), len(off) - 1
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(docs, np.int64)
    ok = inside[data]
    left = np.empty(n, bool)
    left[0] = True
    np.logical_not(ok[:-1], out=left[1:])
    right = np.empty(n, bool)
    right[-1] = True
    np.logical_not(ok[1:], out=right[:-1])
    edge = off[:-1][off[:-1] < off[1:]]
    left[edge] = True
    right[edge[edge > 0] - 1] = True
    starts, ends = np.flatnonzero(ok & left), np.flatnonzero(ok & right) + 1
    first = np.searchsorted(starts, off)
    counts = np.diff(first)
    return starts, ends, np.repeat(np.arange(docs), counts), counts


