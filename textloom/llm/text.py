"""Vectorised text primitives over Arrow string buffers.

Words are maximal runs of bytes outside space and 0x09-0x0D, after lower-casing
A-Z, which on UTF-8 is the same as on code points. Everything works on slices
of bounded size, so memory does not follow the length of a text or a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_LIBC = ctypes.CDLL(None)
_TRIM = getattr(_LIBC, "malloc_trim", None)
if hasattr(_LIBC, "mallopt"):
    _LIBC.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD: large arrays go back to the system as soon as they are freed
SLICE = 1 << 18  #: bytes; four of these make a slice of rows
HASHED = 1 << 16  #: bytes hashed at a time
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_PRIME, _POINT = np.uint64((1 << 31) - 1), 1_358_272_097  #: the second lane's modulus, and where it evaluates
_POW: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_TABLE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _BASE)
_SMALL = _TABLE >> np.uint64(49)  #: 15 bits, so that HASHED products with residues add up below 2^62


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for x below 2^62."""
    x = (x & _PRIME) + (x >> np.uint64(31))
    x = (x & _PRIME) + (x >> np.uint64(31))
    x[x >= _PRIME] -= _PRIME
    return x


def _residues(base: int, n: int) -> np.ndarray:
    """Powers of base modulo 2^31 - 1, by doubling."""
    out = np.ones(n, dtype=np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = _reduced(out[:m] * np.uint64(pow(base, k, int(_PRIME))))
        k += m
    return out


def _powers(n: int) -> list[np.ndarray]:
    """Powers of both lanes' points and of their inverses."""
    if not _POW or len(_POW[0]) < n:
        size = max(n, HASHED + 4096)
        out = []
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        out += [_residues(_POINT, size), _residues(pow(_POINT, -1, int(_PRIME)), size)]
        if size > 4 * SLICE:
            return out
        _POW[:] = out
    return _POW


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and row offsets of a string column; null reads as empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(column: pa.Array, most: int = 4 * SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes of text, one row at least."""
    _, offsets = buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: workers live on between tasks and share their executor's limit."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more entry than rows)."""
    inside = ~breaks[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are sorted and do not overlap.

    Two polynomials of the bytes are mixed: one modulo 2^64, and one modulo a prime, as the first alone
    lets strings of a regular shape coincide.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse, residue, unresidue = _powers(hi - lo + 1)
        own = data[lo:hi]
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_TABLE[own] * power[: hi - lo], out=sums[1:])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        first = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)
        part = _SMALL[own] * residue[: hi - lo]
        if hi - lo > HASHED:
            part = (part & _PRIME) + (part >> np.uint64(31))
        np.cumsum(part, out=sums[1:])
        out[i:j] = mix(first ^ mix(_reduced(_reduced(sums[b] - sums[a]) * unresidue[a])))
        i = j
    return out


def words(column: pa.Array, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in row order, and for each row the index of its first."""
    data, offsets = buffers(column)
    data = _LOWER[data]
    starts, ends, first = word_spans(data, offsets, breaks)
    return span_hashes(data, starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles of each row, repeats included, and each row's first.

    A row with fewer words than `width` has its whole sequence as one; a row without words has none.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    begin = np.concatenate([[0], np.cumsum(n)])
    rows = np.repeat(np.arange(len(n)), n)
    at = first[:-1][rows] + (np.arange(begin[-1]) - begin[:-1][rows])
    take = np.minimum(counts[rows], width)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    out = take.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(width):
        out = mix(out + np.where(take > k, padded[at + k], np.uint64(0)) * np.uint64(2 * k + 1) + np.uint64(k))
    return out, begin


def distinct_per_row(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and each row's first."""
    parts, n = [], np.zeros(len(begin), dtype=np.int64)
    for i in range(len(begin) - 1):
        v = np.sort(values[begin[i] : begin[i + 1]])
        if len(v) > 1:
            keep = np.empty(len(v), dtype=bool)
            keep[0] = True
            np.not_equal(v[1:], v[:-1], out=keep[1:])
            v = v[keep]
        parts.append(v)
        n[i + 1] = len(v)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.cumsum(n)
