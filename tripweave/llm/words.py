"""Words of texts as numpy arrays: no Python object per word.

A word is a maximal run of characters other than ``\\x00-\\x2F \\x3A-\\x60 \\x7B-\\x7F``
after A-Z became a-z.  In UTF-8 these are the bytes 0-9, a-z and all from 0x80, so
words can be found on bytes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_BYTES >= 128)
_DRAW = np.random.default_rng(0x5EED)
_VALUES = _DRAW.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after it
    hashes: np.ndarray  # uint64
    offsets: np.ndarray  # words of text i are offsets[i]:offsets[i + 1]

    def text_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross an offset."""
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    first = padded[1:-1] & ~padded[:-2]
    last = padded[1:-1] & ~padded[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, which must not be empty nor overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    values = _VALUES[data[place + np.repeat(starts, lengths)]] * powers(_BASE, int(lengths.max()))[place]
    return mix(np.add.reduceat(values, heads) ^ lengths.astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = runs(IN_WORD[data], offsets)
    return Words(starts, ends, hash_spans(LOWER[data], starts, ends), np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n`` consecutive values; one for each value but the last n - 1."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * _STEP + hashes[i : len(hashes) - n + 1 + i]
    return mix(out)
