"""Vectorised word spans and hashes over the UTF-8 buffers of Arrow string columns.

Everything works on whole texts. A batch is cut between documents into slices of
about ``SLICE_BYTES`` so that numpy temporaries stay small; a document is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
U64 = np.uint64

_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(1, 2**63 - 1, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Bytes of words ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or BASE**-i) modulo 2**64 for i < n, kept between calls."""
    key = "inv" if inverse else "pow"
    if key not in _powers or len(_powers[key]) < n:
        size = max(n, SLICE_BYTES + (1 << 17))
        out = np.full(size, _BASE_INV if inverse else _BASE, dtype=np.uint64)
        out[0] = 1
        _powers[key] = np.cumprod(out, dtype=np.uint64)
    return _powers[key][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, col.offset * 8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8, hi - lo, lo) if data is not None and hi > lo else np.zeros(0, np.uint8)
    return raw, offsets - lo


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of whole documents of about ``limit`` bytes (one document at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def spans(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word; words never cross documents."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = word_byte[raw]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, end, doc


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of value(raw[t]) * BASE**t for i <= t < j."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * powers(len(raw)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal strings wherever they stand."""
    inv = powers(len(prefix), inverse=True)
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


def word_hashes(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word of a slice; ``raw`` is lower-cased by the caller if wanted."""
    start, end, doc = spans(raw, offsets, word_byte)
    if not len(start):
        return np.zeros(0, np.uint64), doc
    return span_hash(prefix_hash(raw), start, end), doc


def string_hash(word: str) -> int:
    """The hash ``word_hashes`` gives this one word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(span_hash(prefix_hash(raw), np.array([0]), np.array([len(raw)]))[0])
