"""Words of whole texts as arrays: split, hashed and shingled per Arrow batch.

A word is a maximal run of characters other than space and ``\\t\\n\\v\\f\\r``;
all of those are single bytes in UTF-8, so words are found on the raw bytes
of the Arrow buffer, with no Python string per word. A-Z count as a-z. A
word's 64-bit hash is a polynomial over random per-byte values; equal words
have equal hashes in every task, process and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SLICE_BYTES = 1 << 20
STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    return mix(np.arange(start, start + n, dtype=U64) * STEP)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BREAK = _SPACE.copy()  # the same, with ASCII punctuation
_BREAK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_VALUE = seeds(256, 1000)
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]
_POWERS = (np.ones(1, U64), np.ones(1, U64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse; the tables grow and are kept,
    but for those of a very long text."""
    global _POWERS
    if n <= len(_POWERS[0]):
        return _POWERS
    size = 1 << int(n - 1).bit_length()
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(size, base, U64)
        p[0] = 1
        out.append(np.cumprod(p))
    if size <= 4 * SLICE_BYTES:
        _POWERS = (out[0], out[1])
    return out[0], out[1]


@dataclass
class Words:
    """Words of a slice of texts. ``offsets[i]:offsets[i + 1]`` are text i's words."""

    hash: np.ndarray     # uint64 per word
    start: np.ndarray    # first byte of each word in ``data``
    end: np.ndarray      # byte after each word
    offsets: np.ndarray  # words before each text, n + 1 entries
    data: np.ndarray     # UTF-8 bytes of the slice
    bytes: np.ndarray    # byte offsets of the texts in ``data``, n + 1 entries

    def of(self, i: int) -> np.ndarray:
        return self.hash[self.offsets[i]:self.offsets[i + 1]]


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]:o[-1]], o - o[0]


def words(column: pa.Array, punctuation: bool = True) -> Words:
    """Split and hash every text of an Arrow string column (null = empty).

    Without ``punctuation``, ASCII punctuation separates words like space."""
    data, offs = _text_bytes(column)
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), e, e, np.zeros(len(offs), np.int64), data, offs)
    space = (_SPACE if punctuation else _BREAK)[data]
    first = np.empty(n + 1, bool)  # a word may begin here
    first[0], first[1:n], first[n] = True, space[:-1], True
    first[offs] = True
    start = np.flatnonzero(first[:n] & ~space)
    after = np.empty(n + 1, bool)  # a word may end before this byte
    after[1:n], after[n] = space[1:], True
    after[offs], after[0] = True, False
    end = np.flatnonzero(after[1:] & ~space) + 1
    power, inverse = _powers(n + 1)
    total = np.empty(n + 1, U64)
    total[0] = 0
    np.cumsum(_VALUE[data] * power[:n], out=total[1:])
    h = (total[end] - total[start]) * inverse[start] + (end - start).astype(U64) * STEP
    return Words(mix(h), start, end, np.searchsorted(start, offs), data, offs)


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` of text (one row at least), to bound memory."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    lo, held = 0, 0
    for i, s in enumerate(sizes):
        if held and held + s > max_bytes:
            yield lo, i
            lo, held = i, 0
        held += s
    if lo < len(sizes):
        yield lo, len(sizes)


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (in order); fewer words: the whole sequence as one."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.zeros(n, U64)
    for j in range(k):
        out = out * U64(0xD6E8FEB86659FD93) + h[j:j + n]
    return mix(out + U64(k))


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    return np.unique(shingle_hashes(h, k))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
