"""Vectorised hashing of words, byte strings and windows, and winnowing, on numpy arrays.

All hashes are polynomials modulo 2**64 with odd bases, read off prefix sums and then mixed, so the hash of any
substring costs a constant number of array operations and is the same on every machine.
"""

from __future__ import annotations

import numpy as np

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
#: ASCII white space: \x09-\x0D and \x20.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of x over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Powers:
    """base**i and its inverse for any i, from two tables of 65,536 entries each."""

    def __init__(self, base: np.uint64):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        big = [np.uint64(pow(int(x), _STEP, 1 << 64)) for x in (base, inverse)]
        self.low = [_powers(x, _STEP) for x in (base, inverse)]
        self.high = [_powers(x, _STEP) for x in big]

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of values[i] * base**i, with a leading zero."""
        out = np.zeros(len(values) + 1, np.uint64)
        for at in range(0, len(values), _STEP):
            part = values[at : at + _STEP]
            np.multiply(part, self.low[0][: len(part)] * self.high[0][at // _STEP], out=out[at + 1 : at + 1 + len(part)])
        return np.cumsum(out, dtype=np.uint64)

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hashes of the substrings [start, end)."""
        start = np.asarray(start)
        return (sums[end] - sums[start]) * self.low[1][start & (_STEP - 1)] * self.high[1][start >> 16]


POWERS = tuple(Powers(b) for b in BASES)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words of texts that lie one after another in data, and each word's text."""
    blank = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], blank))  # is the byte before i blank
    starts = np.flatnonzero(~blank & (before[:-1] | edge[:-1]))
    after = np.concatenate((blank[1:], [True])) if len(data) else np.zeros(0, bool)
    ends = np.flatnonzero(~blank & (after | edge[1:])) + 1
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, owner


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = POWERS[0].prefix(BYTE_CODES[data])
    return mix(POWERS[0].between(sums, starts, ends))


def window_hashes(codes: np.ndarray, starts: np.ndarray, width, both: bool = True) -> list[np.ndarray]:
    """One or two independent hashes of the windows codes[s : s + width]."""
    out = []
    for p in POWERS[: 2 if both else 1]:
        out.append(mix(p.between(p.prefix(codes), starts, starts + width)))
    return out


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each i, the place of the smallest hash in hashes[i : i + width], the leftmost of equals.

    Blockwise prefix and suffix minima: constant work an element, whatever the width. Hashes are compared on their
    high bits; the low bits hold the place within a block.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    bits = np.uint64(int(width).bit_length())
    rows = -(-len(hashes) // width)
    keys = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    keys[: len(hashes)] = hashes
    keys = ((keys >> bits) << bits).reshape(rows, width) | np.arange(width, dtype=np.uint64)
    ahead = np.minimum.accumulate(keys, axis=1).ravel()
    behind = np.minimum.accumulate(keys[:, ::-1], axis=1)[:, ::-1].ravel()
    left, right = behind[:n], ahead[width - 1 : width - 1 + n]
    take_right = (right >> bits) < (left >> bits)
    i = np.arange(n, dtype=np.int64)
    block = np.where(take_right, (i + width - 1) // width, i // width)
    low = np.where(take_right, right, left) & ((np.uint64(1) << bits) - np.uint64(1))
    return block * width + low.astype(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return at, np.diff(np.append(at, len(values)))


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Even split of the hash space into n buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
