"""Golomb-Rice coding of sorted unsigned integers, vectorised with NumPy.

A list is stored as its first differences: the quotients by 2**k in unary (one bit stream), the k low bits of each
in a second stream. With k near log2(mean difference) a value costs about k + 1.5 bits.
"""

from __future__ import annotations

import struct

import numpy as np

#: Values packed at a time, a multiple of eight; bounds the bit matrix.
_PART = 1 << 16
_HEAD = "<IBQ"  # values, k, bytes of the unary stream


def pack_bits(values: np.ndarray, k: int) -> bytes:
    """The k low bits of each uint64 value, one after another, low bits first."""
    width, out = (k + 7) // 8, []
    for a in range(0, len(values) if k else 0, _PART):
        raw = np.ascontiguousarray(values[a:a + _PART].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
        out.append(np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :k].ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack_bits(raw: np.ndarray, n: int, k: int) -> np.ndarray:
    """n values of k bits each from packed bytes."""
    out = np.zeros((n, 8), np.uint8)
    for a in range(0, n if k else 0, _PART):
        m = min(_PART, n - a)
        bits = np.unpackbits(raw[a * k // 8:], count=m * k, bitorder="little").reshape(m, k)
        low = np.packbits(bits, axis=1, bitorder="little")
        out[a:a + m, :low.shape[1]] = low
    return out.view("<u8").ravel()


def rice_encode(values: np.ndarray) -> bytes:
    """Encode sorted distinct uint64 values."""
    v = np.asarray(values, np.uint64)
    if not len(v):
        return struct.pack(_HEAD, 0, 0, 0)
    d = np.diff(v, prepend=np.uint64(0))
    mean = float(v[-1]) / len(v)
    k = max(0, min(62, int(np.log2(mean * 0.69)))) if mean > 1.5 else 0
    q = (d >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(q.sum()) + len(v), np.uint8)
    unary[np.cumsum(q + 1) - 1] = 1
    head = np.packbits(unary).tobytes()
    return struct.pack(_HEAD, len(v), k, len(head)) + head + pack_bits(d, k)


def rice_decode(data: bytes) -> np.ndarray:
    """The uint64 values of one encoded list."""
    n, k, size = struct.unpack_from(_HEAD, data)
    if not n:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8, offset=struct.calcsize(_HEAD))
    ones = np.flatnonzero(np.unpackbits(raw[:size]))[:n]
    d = (np.diff(ones, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        d |= unpack_bits(raw[size:], n, k)
    return np.cumsum(d, dtype=np.uint64)
