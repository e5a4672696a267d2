"""Words of many texts at once as 64-bit hashes, in numpy.

The hash of a word is a polynomial over random 64-bit values of its bytes,
mixed at the end; two different words of a corpus with 10**9 of them collide
with a chance of about 3 %, so counts by hash are taken as counts by word.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 21


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its start and that of its last word."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _fold() -> np.ndarray:
    byte = np.arange(256)
    byte[65:91] += 32
    return byte


#: Value of each byte; A-Z have the values of a-z.
_VALUE = mix(_fold().astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
#: Value of each byte; A-Z have values of their own.
AS_WRITTEN = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))

_byte = np.arange(256)
#: Words are what stands between ASCII white space.
SPACED = ~np.isin(_byte, [0x20, *range(0x09, 0x0E)])
#: Words are letters, digits and everything beyond ASCII.
ALNUM = (_byte >= 0x80) | ((_byte >= 48) & (_byte <= 57)) | np.isin(_fold(), range(97, 123))


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word in ``data``, and n + 1 places: the first word of each text."""
    inside = kind[data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        # A word ends where its text ends.
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray = _VALUE) -> np.ndarray:
    """The hash of each word, a few megabytes of text at a time; ``of`` has the value of each byte."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    powers = _powers(int(lengths.max()))
    total = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(total, total[at] + _CHUNK, "right")) - 1, at + 1)
        size = lengths[at:to]
        first = total[at:to] - total[at]
        place = np.arange(total[to] - total[at]) - np.repeat(first, size)
        values = of[data[np.repeat(starts[at:to], size) + place]] * powers[place]
        out[at:to] = np.add.reduceat(values, first)
        at = to
    return mix(out)


def _powers(n: int) -> np.ndarray:
    base = np.full(n, 0xD6E8FEB86659FD93, np.uint64)
    base[0] = 1
    return np.cumprod(base, dtype=np.uint64)
