"""A fixed map from 64-bit keys to 32-bit floats in arrays, looked up by whole vectors."""

from __future__ import annotations

import numpy as np

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MIX = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Open addressing at a load of at most a half; what is not there gives 0."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys, values = keys.astype(np.uint64), values.astype(np.float32)
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys, self.values = np.full(1 << self.bits, EMPTY), np.zeros(1 << self.bits, np.float32)
        slots, self.probes = self.slot(keys), 0
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == EMPTY)
            put = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask
            self.probes += 1

    def __getstate__(self) -> tuple[np.ndarray, np.ndarray]:
        """Without the empty places: what is sent and kept on disk is a fourth or less."""
        full = self.keys != EMPTY
        return self.keys[full], self.values[full]

    def __setstate__(self, state: tuple[np.ndarray, np.ndarray]) -> None:
        self.__init__(*state)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.values[slot], np.float32(0))
        miss = np.flatnonzero((seen != keys) & (seen != EMPTY))
        for _ in range(self.probes):
            if not len(miss):
                break
            slot[miss] = (slot[miss] + 1) & self.mask
            seen = self.keys[slot[miss]]
            hit = seen == keys[miss]
            out[miss[hit]] = self.values[slot[miss[hit]]]
            miss = miss[~hit & (seen != EMPTY)]
        return out
