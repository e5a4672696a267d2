"""Arrays of integers as bytes that compress well."""

from __future__ import annotations

import numpy as np


def planes(values: np.ndarray) -> bytes:
    """Integers with all their first bytes first, then all second ones and so on: equal bytes lie together."""
    values = np.ascontiguousarray(values.astype(values.dtype.newbyteorder("<")))
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(content: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(content, np.uint8).reshape(size, len(content) // size).T).view(kind).ravel()


def ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as planes of their steps."""
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def reascending(content: bytes, kind: str) -> np.ndarray:
    return np.cumsum(unplanes(content, kind), dtype=kind)


def ranges(values: np.ndarray, shards: int) -> list[tuple[int, int, int]]:
    """(shard, start, end) of each shard with some of the ascending 64-bit ``values``: shards are equal ranges of them."""
    ends = np.searchsorted(values, np.array([(k << 64) // shards for k in range(shards)], np.uint64)).tolist()
    return [(k, a, b) for k, (a, b) in enumerate(zip(ends, [*ends[1:], len(values)])) if b > a]


def within(values: np.ndarray, shard: int, shards: int, bits: int) -> np.ndarray:
    """Ascending values of a shard as ascending numbers of ``bits`` bits."""
    width = ((1 << 64) // shards).bit_length()
    return (values - np.uint64((shard << 64) // shards)) >> np.uint64(max(0, width - bits))
