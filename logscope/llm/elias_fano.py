"""Elias-Fano levels: monotone sequences in compact form, searched in place, many keys at once.

A value is cut into low bits, packed side by side, and a high part, written in unary: element ``i`` with
high part ``h`` sets bit ``i + h``.  Between the zeros number ``h - 1`` and ``h`` lie the elements with
high part ``h``, so a successor search is two selections of a zero and a binary search of the low
bits there.  A directory of ones per 64-bit word serves the selections.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_BYTES = np.arange(256, dtype=np.uint8)
_POP8 = np.bitwise_count(_BYTES).astype(np.int64)
#: place of the r-th set bit of a byte
_SEL8 = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


def _select_in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th (from 0) set bit of each 64-bit word."""
    out, left, todo = np.zeros(len(word), np.int64), r.copy(), np.ones(len(word), bool)
    for b in range(8):
        byte = ((word >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)
        n = _POP8[byte]
        here = todo & (left < n)
        out[here] = 8 * b + _SEL8[byte[here], left[here]]
        left -= np.where(todo, n, 0)
        todo &= ~here
    return out


class EliasFano:
    """A sorted sequence of unsigned 64-bit integers over memory-mapped arrays."""

    def __init__(self, values: np.ndarray, store: "Levels"):
        values = np.asarray(values, np.uint64)
        self.n = n = len(values)
        top = int(values[-1]) if n else 0
        self.low_bits = l = max(0, (top // max(n, 1)).bit_length() - 1)
        self.high_max = top >> l
        at = (values >> np.uint64(l)).astype(np.int64) + np.arange(n) if n else np.empty(0, np.int64)
        bits = np.zeros((n + self.high_max + 64) // 64 * 64, np.uint8)
        bits[at] = 1
        self.high = store.add(np.packbits(bits, bitorder="little").view("<u8"))
        ones = np.cumsum(np.bitwise_count(self.high), dtype=np.int64)
        self.ones = store.add(ones)
        packed = []
        for k in range(0, n, 1 << 18):      # bit by bit, a stretch at a time
            part = values[k:k + (1 << 18), None] >> np.arange(l, dtype=np.uint64) & np.uint64(1)
            packed.append(np.packbits(part.astype(np.uint8).ravel(), bitorder="little"))    # a stretch fills whole bytes
        self.low = store.add(np.concatenate([*packed, np.zeros(9, np.uint8)]))

    def _low(self, i: np.ndarray) -> np.ndarray:
        """Low parts of the elements ``i``."""
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        byte, off = bit >> 3, (bit & 7).astype(np.uint64)
        whole = np.ndarray((len(self.low) - 8,), "<u8", self.low, 0, (1,))[byte] >> off
        if self.low_bits > 57:      # may reach into a ninth byte
            more = self.low[byte + 8].astype(np.uint64)
            whole |= np.where(off > 0, more << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return whole & np.uint64((1 << self.low_bits) - 1)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        zeros = (np.arange(1, len(self.ones) + 1, dtype=np.int64) << 6) - self.ones
        w = np.searchsorted(zeros, k, "right")
        before = np.where(w > 0, zeros[np.maximum(w - 1, 0)], 0)
        return (w << 6) + _select_in_word(~self.high[w], k - before)

    def _select1(self, k: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.ones, k, "right")
        before = np.where(w > 0, self.ones[np.maximum(w - 1, 0)], 0)
        return (w << 6) + _select_in_word(self.high[w], k - before)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values of the elements ``i``."""
        i = np.asarray(i, np.int64)
        high = (self._select1(i) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of the first element not below each ``x``, searched from ``first`` up to ``last``."""
        x = np.asarray(x, np.uint64)
        lo, hi = np.full(len(x), self.n, np.int64), np.full(len(x), self.n, np.int64)
        high = x >> np.uint64(self.low_bits)
        here = np.flatnonzero(high <= np.uint64(self.high_max)) if self.n else np.empty(0, np.int64)
        h, inv = np.unique(high[here].astype(np.int64), return_inverse=True)
        hi[here] = (self._select0(h) - h)[inv]
        lo[here] = np.where(h > 0, self._select0(np.maximum(h - 1, 0)) - np.maximum(h - 1, 0), 0)[inv]
        if first is not None:
            lo = np.maximum(lo, first)
        if last is not None:
            hi = np.minimum(hi, last)
        want = x & np.uint64((1 << self.low_bits) - 1)
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            below = self._low(mid) < want[todo]
            lo[todo[below]] = mid[below] + 1
            hi[todo[~below]] = mid[~below]
            todo = todo[lo[todo] < hi[todo]]
        return lo

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of the element equal to each ``x``, or -1."""
        i = self.successor(x, first, last)
        inside = i < (self.n if last is None else last)
        out = np.full(len(i), -1, np.int64)
        at = np.flatnonzero(inside)
        out[at] = np.where(self[i[at]] == np.asarray(x, np.uint64)[at], i[at], -1)
        return out


class Levels:
    """Arrays of one model part in one memory-mapped file that has no name and goes with its task."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.size = 0

    def add(self, array: np.ndarray) -> np.ndarray:
        """``array`` written to the file and mapped back, read-only."""
        array = np.ascontiguousarray(array)
        if not array.nbytes:
            return array
        start = self.size
        self.file.write(array.tobytes())
        self.size += array.nbytes
        pad = -self.size % mmap.ALLOCATIONGRANULARITY
        self.file.write(b"\0" * pad)
        self.size += pad
        self.file.flush()
        mapped = mmap.mmap(self.file.fileno(), array.nbytes, access=mmap.ACCESS_READ, offset=start)
        return np.frombuffer(mapped, array.dtype).reshape(array.shape)

    def close(self) -> None:
        self.file.close()
