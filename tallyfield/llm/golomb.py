"""Golomb-Rice code of sorted distinct integers."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IB")


def encode(values: np.ndarray, universe: int) -> bytes:
    """Code ascending distinct values below a universe: gaps in unary quotient and fixed remainder."""
    n = len(values)
    mean = max(1, universe // max(1, n))
    low = max(0, mean.bit_length() - 1)
    if not n:
        return _HEAD.pack(0, low)
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    high = gaps >> low
    ends = np.cumsum(high + 1)  # each quotient: so many zeros, then a one
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    rest = (gaps[:, None] >> np.arange(low)) & 1
    return _HEAD.pack(n, low) + np.packbits(np.concatenate([unary, rest.astype(np.uint8).ravel()])).tobytes()


def decode(raw: bytes) -> np.ndarray:
    n, low = _HEAD.unpack_from(raw)
    if not n:
        return np.zeros(0, np.int64)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=_HEAD.size))
    ones = np.flatnonzero(bits)[:n]
    high = np.diff(ones, prepend=-1) - 1
    begin = int(ones[-1]) + 1
    rest = bits[begin : begin + n * low].reshape(n, low).astype(np.int64) @ (1 << np.arange(low, dtype=np.int64))
    return np.cumsum((high << low | rest) + 1) - 1
