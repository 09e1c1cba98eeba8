"""Elias-Fano sequences in byte buffers, with vectorised access and successor search.

A sorted sequence is cut into low bits, packed, and high parts, written in
unary into a bit vector: element i sets bit (high + i). Beside the bit vector
lies the number of zeros before each 64-bit word, for select.
"""

from __future__ import annotations

import struct

import numpy as np

CHUNK = 1 << 16
_ONES = np.uint64(0x0101010101010101)
_TOPS, _FIVES = _ONES * np.uint64(0x80), _ONES * np.uint64(0x55)
_THREES, _NIBBLES = _ONES * np.uint64(0x33), _ONES * np.uint64(0x0F)
# Place of the r-th set bit of a byte.
_PLACE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[:8] for byte in range(256)], np.int64)


def _pack(low: np.ndarray, width: int) -> bytes:
    out = []
    shift = np.arange(width, dtype=np.uint64)
    for at in range(0, len(low), CHUNK):
        bits = (low[at:at + CHUNK, None] >> shift) & np.uint64(1)
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def build(values: np.ndarray, universe: int) -> bytes:
    """Bytes for ascending ``values`` (uint64) below ``universe``."""
    n = len(values)
    values = values.astype(np.uint64)
    width = min(56, max(0, (max(1, universe) // max(1, n)).bit_length() - 1))
    low = _pack(values & np.uint64((1 << width) - 1), width) if width else b""
    high = (values >> np.uint64(width)).astype(np.int64)
    last = (universe >> width) + 1
    size = -(-(n + last + 1) // 64) * 64
    bits = np.zeros(size, np.uint8)
    bits[high + np.arange(n)] = 1
    word = np.packbits(bits, bitorder="little").view("<u8")
    zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(word).astype(np.int64))])
    low += b"\0" * (8 + -(len(low) + 8) % 8)
    return b"".join([struct.pack("<QQQQ", n, width, len(low), len(word)), low, word.tobytes(),
                     zeros.astype("<u8").tobytes()])


class EliasFano:
    """Reader over a buffer; ``stop`` is the offset after the sequence."""

    def __init__(self, data: memoryview, at: int = 0):
        self.n, width, low, words = struct.unpack_from("<QQQQ", data, at)
        self.width = width
        at += 32
        self._low = np.ndarray((low - 7,), "<u8", data, at, (1,))
        at += low
        self._word = np.frombuffer(data, "<u8", words, at)
        at += 8 * words
        self._zeros = np.frombuffer(data, "<u8", words + 1, at)
        self.stop = at + 8 * (words + 1)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.width
        return (self._low[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64(
            (1 << self.width) - 1)

    @staticmethod
    def _nth(word: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Place of the r-th (from 0) set bit of each word: its byte by the running
        counts of set bits, held in one word, then the bit by a table."""
        r = r.astype(np.uint64)
        x = word - ((word >> np.uint64(1)) & _FIVES)
        x = (x & _THREES) + ((x >> np.uint64(2)) & _THREES)
        running = ((x + (x >> np.uint64(4))) & _NIBBLES) * _ONES
        passed = np.bitwise_count(((r * _ONES | _TOPS) - running) & _TOPS).astype(np.uint64)
        shift = np.minimum(passed, np.uint64(7)) << np.uint64(3)
        r = r - (((running << np.uint64(8)) >> shift) & np.uint64(255))
        byte = (word >> shift) & np.uint64(255)
        return shift.astype(np.int64) + _PLACE[byte, np.minimum(r, np.uint64(7))]

    def _select0(self, k: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self._zeros, k.astype(np.uint64), "right") - 1
        return 64 * w + self._nth(~self._word[w], k - self._zeros[w].astype(np.int64))

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each value (ascending queries are fastest), -1 where it is
        not its own successor in the sequence."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        high = (x >> np.uint64(self.width)).astype(np.int64)
        low = x & np.uint64((1 << self.width) - 1)
        inside = high < int(self._zeros[-1]) - 1
        high = np.where(inside, high, 0)
        end = self._select0(high) - high
        start = np.where(high > 0, self._select0(np.maximum(high - 1, 0)) + 1 - high, 0)
        open_ = np.flatnonzero(start < end)
        a, b, want = start[open_], end[open_], low[open_]
        while len(open_):
            mid = (a + b) >> 1
            less = self._lows(mid) < want
            a, b = np.where(less, mid + 1, a), np.where(less, b, mid)
            start[open_] = a
            on = a < b
            open_, a, b, want = open_[on], a[on], b[on], want[on]
        found = inside & (start < end)
        found &= self._lows(np.minimum(start, self.n - 1)) == low
        return np.where(found, start, -1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at indices ``i``."""
        ones_before = 64 * np.arange(len(self._zeros), dtype=np.int64) - self._zeros.astype(np.int64)
        w = np.searchsorted(ones_before, i, "right") - 1
        place = 64 * w + self._nth(self._word[w], i - ones_before[w])
        return ((place - i).astype(np.uint64) << np.uint64(self.width)) | (
            self._lows(i) if self.width else np.uint64(0))
