"""Words of many texts at once: where they are, and 64-bit hashes of them.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. All functions work on the UTF-8 bytes of a batch, without a loop over words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# bytes that continue a code point
CONTINUES = (np.arange(256) & 0xC0) == 0x80
# bytes of words that are hashed with one table of powers; a longer word has its own
BLOCK = 1 << 20
ODD = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTES = mix(np.arange(1, 257, dtype=U) * ODD)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def find(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; rows begin at `offsets` and words end with them.
    `blank` tells which bytes are outside words."""
    inside = np.concatenate([~blank[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_POWERS = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `n` powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        base = 0xD1342543DE82EF95
        for k, x in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(max(n, BLOCK), U(x))
            steps[0] = U(1)
            _POWERS[k] = np.cumprod(steps)
    out = _POWERS[0], _POWERS[1]
    if n > BLOCK:
        _POWERS[:] = [x[:BLOCK].copy() for x in out]
    return out


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word; equal words have equal hashes wherever they stand."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = powers(high - low)
        total = np.zeros(high - low + 1, U)
        np.cumsum(BYTES[data[low:high]] * up[: high - low], out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        i = j
    return out


def windows(hashed: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words of one row, and where each begins."""
    n = len(hashed) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    total = np.zeros(len(at), U)
    for k in range(size):
        total += hashed[at + k] * mix(np.array([k + 1], U) * ODD)[0]
        total = mix(total)
    return total, at


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]
