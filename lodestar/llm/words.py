"""Vectorised words, word hashes and window hashes over the bytes of many texts.

A word is a maximal run of bytes other than space and 0x09-0x0D.  These are
ASCII, so working on UTF-8 bytes gives the same words as working on code
points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BLOCK = 1 << 19


def odd_constants(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers, the same in every process."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values (a bijection), so that all bits are usable."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, seed: int):
        self.base = int(odd_constants(seed, 1)[0])
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, _BLOCK + 4096)
            self.up = np.cumprod(np.concatenate([[U64(1)], np.full(n - 1, self.base, np.uint64)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[U64(1)], np.full(n - 1, self.inverse, np.uint64)]), dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers(11)


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of the bytes of each span; spans ascend and do not overlap."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        lo = start[at]
        stop = max(at + 1, int(np.searchsorted(end, lo + _BLOCK, side="right")))
        part = raw[lo:end[stop - 1]]
        up, down = _POWERS.get(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + U64(1)) * up[:len(part)], out=total[1:])
        s, e = start[at:stop] - lo, end[at:stop] - lo
        out[at:stop] = (total[e] - total[s]) * down[s]
        at = stop
    return mix(out + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``raw``, each text's range of words and of bytes."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text's number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit polynomial hash of each word's bytes."""
        return span_hashes(_LOWER[self.raw] if lower else self.raw, self.start, self.end)

    def windows(self, hashes: np.ndarray, size: int, seed: int = 21) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` consecutive words of one text, and the word each starts at."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j, c in enumerate(odd_constants(seed, size)):
            total += hashes[j:j + n] * c
        left = np.repeat(self.first[1:], self.counts)[:n] - np.arange(n)
        at = np.flatnonzero(left >= size)
        return mix(total[at]), at

    def window_counts(self, at: np.ndarray) -> np.ndarray:
        """How many of the window starts ``at`` each text has."""
        return np.diff(np.searchsorted(at, self.first))


def solid_bytes(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to words."""
    return ~_SPACE[raw]


def words_of(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts whose bytes are ``raw[offsets[i]:offsets[i + 1]]``."""
    solid = solid_bytes(raw)
    n = len(raw)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    some = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[some] = False
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets), offsets)
