"""Vectorised splitting and hashing of Arrow text columns.

All helpers run inside tasks on one bounded slice of a record batch at a time.
Hashes are 64-bit polynomials over a fixed byte table, the same in every
process; two different inputs collide with probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)          # odd, so it has an inverse mod 2^64
_INV = U64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
_NGRAM = U64(0xD6E8FEB86659FD93)
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2 ** 63, 256, dtype=np.uint64)


def _mask(*ranges) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


#: separators of ``[^\x20\x09-\x0D]+``
SPACE = _mask((0x20, 0x20), (0x09, 0x0D))
#: separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
PUNCT = _mask((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

SLICE_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_slices(column, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` for runs of rows of a text column, each run
    at most ``max_bytes`` long unless one text alone is longer. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offs = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + max_bytes, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, buf[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray, sep: np.ndarray):
    """Starts and ends of all words and, per row, the index of its first word
    (one more entry than rows). Words never reach over a row's end."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    gap = sep[buf]
    edge = np.empty(n + 1, bool)
    edge[1:] = gap
    edge[offs[offs <= n]] = True
    edge[0] = True
    starts = np.flatnonzero(~gap & edge[:-1])
    edge[:-1] = gap
    edge[n] = True
    edge[offs] = True
    ends = np.flatnonzero(~gap & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offs)


_pow = np.ones(1, np.uint64)
_ipow = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of them."""
    global _pow, _ipow
    if len(_pow) < n:
        size = 1 << (n - 1).bit_length()
        step = np.full(size, _BASE)
        step[0] = 1
        _pow = np.cumprod(step, dtype=np.uint64)
        step[1:] = _INV
        _ipow = np.cumprod(step, dtype=np.uint64)
    return _pow, _ipow


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`range_hash` takes the hash of any range."""
    pw, _ = powers(len(buf) + 1)
    acc = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[buf] * pw[:len(buf)], out=acc[1:])
    return acc


def range_hash(acc: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, ip = powers(len(acc))
    return mix((acc[ends] - acc[starts]) * ip[starts])


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                block: int = 1 << 17) -> np.ndarray:
    """64-bit hash of each word, computed in blocks of words."""
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(starts), block):
        s, e = starts[a:a + block], ends[a:a + block]
        lo = s[0]
        out[a:a + block] = range_hash(prefix_sums(buf[lo:e[-1]]), s - lo, e - lo)
    return out


def ngram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries (across row ends too)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= _NGRAM
        out += h[i:n + i]
    return mix(out)
