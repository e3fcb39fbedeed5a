"""Sets of five-word shingles as sorted 64-bit hashes, and one-permutation MinHash bands over them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .words import LOWER, NOT_SPACE, mix, word_hashes

WORDS = 5
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """Each document's distinct shingles, sorted; a text of fewer words is one shingle, without words none."""
    h, doc = word_hashes(LOWER[raw], offsets, NOT_SPACE)
    at = np.searchsorted(doc, np.arange(len(offsets)))
    if len(h) >= words:
        s = np.zeros(len(h) - words + 1, np.uint64)
        for j in range(words):
            s = mix(s * _STEP + h[j:len(h) - words + 1 + j])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            v = np.sort(s[a:b - words + 1])
            out.append(v[np.r_[True, v[1:] != v[:-1]]])
        elif b > a:
            one = np.array([b - a], np.uint64)
            for x in h[a:b]:
                one = mix(one * _STEP + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


@lru_cache(maxsize=4)
def _donors(bins: int, tries: int) -> np.ndarray:
    """tries x bins: the bin that an empty bin asks at each try, the same for all documents."""
    t, b = np.meshgrid(np.arange(tries, dtype=np.uint64), np.arange(bins, dtype=np.uint64), indexing="ij")
    return ((mix(mix(b + np.uint64(1)) + t * _STEP) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)


def one_permutation(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """documents x bins minima with optimal densification; rows of empty sets are 0.

    The bin of a hash is given by its top bits, so in a sorted set the first hash of a bin
    is its minimum. An empty bin takes the minimum of the first non-empty bin in its own
    random sequence, which is the same sequence in every document.
    """
    n = len(sets)
    out, full = np.zeros((n, bins), np.uint64), np.zeros((n, bins), bool)
    size = np.array([len(s) for s in sets])
    if not size.sum():
        return out
    h = np.concatenate(sets)
    doc = np.repeat(np.arange(n), size)
    b = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    head = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (b[1:] != b[:-1])])
    out[doc[head], b[head]] = h[head]
    full[doc[head], b[head]] = True
    rows, cols = np.nonzero(~full & (size > 0)[:, None])
    tries, t = 64, 0
    while len(rows):
        if t == tries:
            tries *= 4
        donor = _donors(bins, tries)[t][cols]
        hit = full[rows, donor]
        out[rows[hit], cols[hit]] = out[rows[hit], donor[hit]]
        rows, cols, t = rows[~hit], cols[~hit], t + 1
    return out


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """documents x bands keys of ``rows`` neighbouring bins each; the band number is part of the key."""
    n, bins = minima.shape
    grid = minima.reshape(n, bins // rows, rows)
    key = np.broadcast_to(mix(np.arange(bins // rows, dtype=np.uint64) + np.uint64(7)), grid.shape[:2]).copy()
    for j in range(rows):
        key = mix(key * _STEP + grid[:, :, j])
    return key


def set_hash(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share, as two signed columns."""
    a, b = [], []
    for s in sets:
        a.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) if len(s) else np.uint64(0))
        b.append(np.bitwise_xor.reduce(mix(s + np.uint64(0x5851F42D4C957F2D))) if len(s) else np.uint64(0))
    return np.array(a, np.uint64).view(np.int64), np.array(b, np.uint64).view(np.int64)
