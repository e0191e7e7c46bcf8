"""Words of many texts at once, as numpy arrays.

A word is a longest run of bytes other than space and the controls 9 to 13, with A-Z lowered. Since
these bytes never occur inside a UTF-8 sequence, this equals `[^\\x20\\x09-\\x0D]+` on characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_rng = np.random.default_rng(20240131)
BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(step: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def segment_hash(values: np.ndarray, lengths: np.ndarray, step: np.uint64 = STEP) -> np.ndarray:
    """Hash of consecutive segments of values, none of them empty, in the order of their values."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(values)) - np.repeat(first, lengths)
    weighted = values * powers(step, int(lengths.max()))[place]
    return mix(np.add.reduceat(weighted, first) + lengths.astype(np.uint64))


@dataclass
class Words:
    """Words of a run of texts. Text i has words offsets[i] to offsets[i + 1]."""

    data: np.ndarray  # all bytes, a newline after each text
    begins: np.ndarray  # first byte of each text in data
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    offsets: np.ndarray
    hashes: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def words(texts: list[bytes], hashed: bool = True) -> Words:
    joined = b"\n".join(texts).lower() + b"\n"
    data = np.frombuffer(joined, np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    inside = ~SPACE[data]
    change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = change[::2], change[1::2]
    offsets = np.searchsorted(starts, begins)
    hashes = segment_hash(BYTE_VALUES[data[inside]], ends - starts) if hashed else starts[:0]
    return Words(data, begins[:-1], starts, ends, offsets, hashes)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; one fewer than n shorter than hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    weights = powers(np.uint64(0xD6E8FEB86659FD93), n)
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    for j in range(n):
        total += hashes[j : j + size] * weights[j]
    return mix(total)
