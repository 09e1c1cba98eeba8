"""Golomb coding (with powers of two) of sorted distinct whole numbers.

Gaps are split into a quotient in unary and ``k`` low bits. The two parts lie
in streams of their own, so that numpy codes and reads all gaps at once.
"""

from __future__ import annotations

import numpy as np

_HEAD = np.dtype([("n", "<u4"), ("k", "<u4"), ("unary", "<u4")])


def encode(values: np.ndarray, base: int) -> bytes:
    """Code of strictly increasing uint64 ``values``, none below ``base``."""
    n = len(values)
    if n == 0:
        return np.zeros(1, _HEAD).tobytes()
    gaps = np.diff(values, prepend=np.uint64(base)).astype(np.uint64)
    gaps[1:] -= np.uint64(1)
    k = max(0, int((int(values[-1]) - int(base)) // n).bit_length() - 1)
    stops = np.cumsum((gaps >> np.uint64(k)) + np.uint64(1)).astype(np.int64) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    low = np.zeros((n, k), np.uint8)
    for bit in range(k):
        low[:, bit] = (gaps >> np.uint64(bit)) & np.uint64(1)
    head = np.zeros(1, _HEAD)
    first, second = np.packbits(unary).tobytes(), np.packbits(low).tobytes()
    head["n"], head["k"], head["unary"] = n, k, len(first)
    return head.tobytes() + first + second


def decode(code: bytes, base: int) -> np.ndarray:
    """The values that :func:`encode` got with the same ``base``."""
    head = np.frombuffer(code, _HEAD, 1)[0]
    n, k, cut = int(head["n"]), int(head["k"]), _HEAD.itemsize + int(head["unary"])
    if n == 0:
        return np.zeros(0, np.uint64)
    body = np.frombuffer(code, np.uint8)
    stops = np.flatnonzero(np.unpackbits(body[_HEAD.itemsize:cut]))
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    low = np.unpackbits(body[cut:], count=n * k).reshape(n, k)
    for bit in range(k):
        gaps |= low[:, bit].astype(np.uint64) << np.uint64(bit)
    gaps[1:] += np.uint64(1)
    return np.uint64(base) + np.cumsum(gaps, dtype=np.uint64)
