"""Numpy arrays as compressed byte strings, so that Spark shuffles few large rows instead of many small ones."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa


def pack(*arrays: np.ndarray) -> bytes:
    """One byte string of one-dimensional arrays. 8-byte integers are stored as differences, wide items by byte planes."""
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        if a.dtype.itemsize == 8 and a.dtype.kind in "iu":
            a = np.diff(a.view(np.uint64), prepend=np.uint64(0))
        raw = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if a.dtype.itemsize > 1 else a.tobytes()
        body += [struct.pack("<q", len(a)), raw]
    data = b"".join(body)
    return struct.pack("<q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    """The arrays of ``pack``, of the given dtypes."""
    raw = pa.decompress(data[8:], struct.unpack("<q", data[:8])[0], codec="zstd", asbytes=True)
    out, at = [], 0
    for kind in map(np.dtype, kinds):
        n = struct.unpack("<q", raw[at:at + 8])[0]
        at += 8
        a = np.frombuffer(raw, np.uint8, n * kind.itemsize, at)
        at += n * kind.itemsize
        a = np.ascontiguousarray(a.reshape(kind.itemsize, n).T).view(kind).reshape(n) if kind.itemsize > 1 else a.view(kind)
        if kind.itemsize == 8 and kind.kind in "iu":
            a = np.cumsum(a.view(np.uint64), dtype=np.uint64).view(kind)
        out.append(a)
    return out


def unpack_all(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    """Arrays of several byte strings, joined end to end."""
    parts = [unpack(b, *kinds) for b in blobs]
    return [np.concatenate([np.zeros(0, k), *(p[i] for p in parts)]) for i, k in enumerate(kinds)]
