"""Golomb codes of sorted numbers, written and read by whole arrays.

Sorted distinct numbers are stored by their gaps. A gap is cut by a power of two near the mean gap: quotients
stand in unary in one stream of bits, remainders in a fixed number of bits in another. With the two streams
apart, both are decoded without a loop over the numbers. The code takes about log2(mean gap) + 2 bits a number.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<IB")


def encode(values: np.ndarray) -> bytes:
    """Code of ascending distinct numbers from 0 to 2**62."""
    n = len(values)
    if not n:
        return HEAD.pack(0, 0)
    gaps = np.diff(values.astype(np.int64), prepend=-1) - 1
    width = max(0, (int(gaps.sum()) // n).bit_length() - 1)
    ends = np.cumsum((gaps >> width) + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    rests = ((gaps[:, None] >> np.arange(width)) & 1).astype(np.uint8)
    return HEAD.pack(n, width) + np.packbits(unary).tobytes() + np.packbits(rests.ravel()).tobytes()


def decode(code: bytes) -> np.ndarray:
    n, width = HEAD.unpack_from(code)
    if not n:
        return np.zeros(0, np.int64)
    body = np.frombuffer(code, np.uint8, offset=HEAD.size)
    rest_bytes = (n * width + 7) // 8
    unary = np.unpackbits(body[: len(body) - rest_bytes])
    gaps = (np.diff(np.flatnonzero(unary), prepend=-1) - 1) << width
    bits = np.unpackbits(body[len(body) - rest_bytes :], count=n * width).reshape(n, width)
    gaps = gaps + (bits.astype(np.int64) << np.arange(width)).sum(axis=1)
    return np.cumsum(gaps + 1) - 1
