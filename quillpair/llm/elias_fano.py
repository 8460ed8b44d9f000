"""Elias-Fano coded monotone sequences over NumPy arrays that may be memory-mapped.

A value's low bits are packed; its high part h is coded by a one at place i + h of a bit vector (i: its index). A
directory counts the ones before each 64-bit word of that vector, a second one the zeros, for sequences in which values
are sought. All queries are vectorised over many arguments.
"""

from __future__ import annotations

import numpy as np

from .coding import pack_bits

_U = np.uint64


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


#: Place of the r-th one of a byte, at 8 * byte + r.
_IN_BYTE = np.array([([p for p in range(8) if b >> p & 1] + [0] * 8)[:8] for b in range(256)], np.int64).ravel()
_BYTES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def _in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th (from 0) one in each 64-bit word, which has it: by its byte, then by table."""
    r = r.astype(_U)
    sums = word - ((word >> _U(1)) & _U(0x5555555555555555))
    sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
    sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _BYTES  # each byte: ones up to its end
    at = np.bitwise_count(((r * _BYTES | _TOPS) - sums) & _TOPS).astype(_U) << _U(3)
    at &= _U(63)
    left = r - (((sums << _U(8)) >> at) & _U(255))
    return at.astype(np.int64) + _IN_BYTE[((((word >> at) & _U(255)) << _U(3)) | left & _U(7)).astype(np.int64)]


class EliasFano:
    """Non-decreasing uint64 values below `bound`."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones, self.zeros = n, low_bits, low, high, ones, zeros

    @classmethod
    def of(cls, values: np.ndarray, bound: int, sought: bool = True) -> "EliasFano":
        """Without `sought` the sequence has get() only."""
        v = np.asarray(values, _U)
        n = len(v)
        k = max(0, min(63, (bound // max(n, 1)).bit_length() - 1))
        low = _words(np.frombuffer(pack_bits(v, k), np.uint8), 1)
        places = (v >> _U(k)).astype(np.int64) + np.arange(n)
        top = (int(bound) >> k) + n + 1
        vector = np.zeros(top, np.uint8)
        vector[places] = 1
        high = _words(np.packbits(vector, bitorder="little"), 1)
        ones = np.concatenate([[0], np.cumsum(_popcount(high))])
        zeros = 64 * np.arange(len(high) if sought else 0) - ones[:len(high) if sought else 0]
        return cls(n, k, low, high, ones.astype("<u4" if n < 1 << 32 else "<u8"),
                   zeros.astype("<u4" if 64 * len(high) < 1 << 32 else "<u8"))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], "<i8"), self.low, self.high, self.ones, self.zeros]

    @classmethod
    def from_arrays(cls, head, low, high, ones, zeros) -> "EliasFano":
        return cls(int(head[0]), int(head[1]), low, high, ones, zeros)

    def _select1(self, i: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.ones, i.astype(self.ones.dtype), "right") - 1
        return w * 64 + _in_word(self.high[w], i - self.ones[w].astype(np.int64))

    def _select0(self, i: np.ndarray) -> np.ndarray:
        """Place of the i-th (from 0) zero."""
        w = np.searchsorted(self.zeros, i.astype(self.zeros.dtype), "right") - 1
        return w * 64 + _in_word(~self.high[w], i - self.zeros[w].astype(np.int64))

    def _lows(self, i: np.ndarray) -> np.ndarray:
        k = self.low_bits
        if not k:
            return np.zeros(len(i), _U)
        p = i * k
        w, o = p >> 6, (p & 63).astype(_U)
        v = self.low[w] >> o
        over = np.where(o > 0, self.low[w + 1] << ((_U(64) - o) & _U(63)), _U(0))
        return (v | over) & _U((1 << k) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at indices i."""
        i = np.asarray(i, np.int64)
        return ((self._select1(i) - i).astype(_U) << _U(self.low_bits)) | self._lows(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value that equals x, or -1: the successor of x, if it is x itself. x below the bound."""
        x = np.asarray(x, _U)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        h = (x >> _U(self.low_bits)).astype(np.int64)
        low = x & _U((1 << self.low_bits) - 1)
        a = np.where(h > 0, self._select0(np.maximum(h - 1, 0)) - (h - 1), 0)  # values with a smaller high part
        end = self._select0(h) - h
        b = end
        while (open_ := a < b).any():  # lowest index in [a, b) whose low part is not below the sought one
            at = np.flatnonzero(open_)
            mid = (a[at] + b[at]) // 2
            less = self._lows(mid) < low[at]
            a[at[less]] = mid[less] + 1
            b = b.copy() if b is end else b
            b[at[~less]] = mid[~less]
        at = np.flatnonzero(a < end)
        hit = at[self._lows(a[at]) == low[at]]
        out[hit] = a[hit]
        return out


def _words(raw: np.ndarray, spare: int) -> np.ndarray:
    """Bytes as 64-bit words, with zero words to spare at the end."""
    size = -(-len(raw) // 8) + spare
    out = np.zeros(size * 8, np.uint8)
    out[:len(raw)] = raw
    return out.view("<u8")


def pack_arrays(arrays: list[np.ndarray]) -> bytes:
    """Arrays in one buffer, each at a multiple of eight bytes, behind a table of contents."""
    head = np.zeros((len(arrays), 3), "<i8")
    at, body = 8 + head.nbytes, []
    for row, a in zip(head, arrays):
        code = a.dtype.str.encode().ljust(8, b"\0")
        row[:] = (int.from_bytes(code, "little", signed=True), at, len(a))
        raw = a.tobytes()
        raw += b"\0" * (-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    return np.int64(len(arrays)).tobytes() + head.tobytes() + b"".join(body)


def map_arrays(buffer: np.ndarray) -> list[np.ndarray]:
    """Views of packed arrays in a byte buffer or memory map; nothing is read before it is used."""
    n = int(buffer[:8].view("<i8")[0])
    out = []
    for code, at, size in buffer[8:8 + 24 * n].view("<i8").reshape(n, 3).tolist():
        kind = np.dtype(int(code).to_bytes(8, "little", signed=True).rstrip(b"\0").decode())
        out.append(buffer[at:at + size * kind.itemsize].view(kind))
    return out
