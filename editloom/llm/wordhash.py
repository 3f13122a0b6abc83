"""Words of many texts at once as numpy arrays: where they are, and a 64-bit hash of each.

The hash is a polynomial over the word's bytes, taken from one running sum over the block; equal words hash alike wherever
they stand. It only screens: whatever it finds is compared byte by byte by the caller.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1_200_000) if n < 4_000_000 else n
        for k, base in enumerate((BASE, INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers


class Words:
    """Words `[^\\x20\\x09-\\x0D]+`, lower-cased (A-Z) or as they are, of a list of UTF-8 texts, in order."""

    def __init__(self, texts: list[bytes], lower: bool = True):
        self.data = b" ".join([b"", *texts, b""])
        if lower:
            self.data = self.data.lower()
        a = np.frombuffer(self.data, np.uint8)
        space = SPACE[a]
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.starts, self.ends = turn[0::2], turn[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_starts = np.concatenate([[1], 1 + np.cumsum(sizes)])
        #: the first word of each text; one more than there are texts
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        up, down = powers(len(self.data))
        a = np.frombuffer(self.data, np.uint8).astype(np.uint64)
        a += np.uint64(1)
        a *= up[: len(a)]
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a, dtype=np.uint64)])
        h = (run[self.ends] - run[self.starts]) * down[self.starts]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def windows(self, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first word, hash) of each run of `size` words within a text."""
        n = len(h) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        g = h[:n].copy()
        for k in range(1, size):
            g *= np.uint64(0x94D049BB133111EB)
            g += h[k : n + k]
        g ^= g >> np.uint64(31)
        at = np.flatnonzero(self.text_of[:n] == self.text_of[size - 1 : n + size - 1])
        return at, g[at]

    def run(self, at: int, size: int) -> bytes:
        return b" ".join([self.data[a:b] for a, b in zip(self.starts[at : at + size].tolist(), self.ends[at : at + size].tolist(), strict=True)])
