"""64-bit hashes of words and of runs of words, for whole texts at once with array operations.

A running sum of value(byte) * odd^place gives the hash of any stretch: the difference of two sums times the inverse power
of the start. The same over word hashes gives the hash of any run of words.
"""

from __future__ import annotations

import numpy as np

_A, _B, ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
OTHER = np.uint64(0xD1B54A32D192ED03)
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a well-known 64-bit generator: a bijection; every bit of x moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def sorted_distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x if len(x) < 2 else x[np.concatenate([[True], x[1:] != x[:-1]])]


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were ever needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            n = max(2 * n, 1 << 12)
            one = np.ones(1, np.uint64)
            self.up = np.cumprod(np.concatenate([one, np.full(n, ODD)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([one, np.full(n, _INVERSE)]), dtype=np.uint64)


class WordHasher:
    """Hashes of a text's words, words being runs of bytes other than space and tab to carriage return."""

    def __init__(self, lower: bool = False):
        values = mix(np.arange(256, dtype=np.uint64) * ODD + OTHER)
        if lower:  # A-Z count as a-z
            values[65:91] = values[97:123]
        self.values = values
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self.powers = Powers()

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) <= _PIECE:
            return self._words(data)
        gaps = np.flatnonzero(self.blank[data])  # long texts are cut at blanks, about every _PIECE bytes
        at = gaps[np.searchsorted(gaps, np.arange(_PIECE, len(data), _PIECE)).clip(max=max(0, len(gaps) - 1))] if len(gaps) else gaps
        return np.concatenate([self._words(p) for p in np.split(data, np.unique(at))])

    def _words(self, data: np.ndarray) -> np.ndarray:
        edge = np.ones(len(data) + 2, bool)
        edge[1:-1] = self.blank[data]
        edges = np.flatnonzero(edge[1:] != edge[:-1])
        starts, ends = edges[::2], edges[1::2]
        self.powers.upto(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers.up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.powers.down[starts] + (ends - starts).astype(np.uint64) * OTHER)


class RunHasher:
    """Hashes of runs of words at any place of one loaded text."""

    def __init__(self):
        self.powers = Powers()

    def load(self, words: np.ndarray) -> None:
        self.words = words
        self.powers.upto(len(words) + 1)
        self.one, self.two = self._sums(words), None

    def _sums(self, values: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers.up[: len(values)], out=sums[1:])
        return sums

    def __call__(self, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
        """Hashes of words[start:end]; the second kind is independent of the first."""
        if second and self.two is None:
            self.two = self._sums(mix(self.words + OTHER))
        sums = self.two if second else self.one
        return mix((sums[ends] - sums[starts]) * self.powers.down[starts] + (ends - starts).astype(np.uint64) * OTHER)
