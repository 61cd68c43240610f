"""Sorted hash arrays: exact vectorised lookup of 64-bit keys in numpy."""

from __future__ import annotations

import numpy as np

# Fixed value: an odd 64-bit multiplier (2^64 / golden ratio); multiplying by it is a bijection on 64-bit keys.
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(keys: np.ndarray) -> np.ndarray:
    """Spread packed keys over 64 bits without collisions."""
    k = keys.astype(np.uint64, copy=False)
    k = k ^ (k >> np.uint64(32))
    return k * MIX


class SortedHashes:
    """Rows of a sorted array of mixed keys, found through an index on the leading hash bits."""

    def __init__(self, keys: np.ndarray):
        """``keys``: distinct packed keys in any order; ``order`` gives their place in the sorted array."""
        hashed = mix(np.asarray(keys, np.uint64))
        self.order = np.argsort(hashed, kind="stable")  # may be dropped once values are in place
        self.size = len(hashed)
        self.hashes = hashed[self.order]
        bits = min(24, max(4, int(np.ceil(np.log2(len(hashed) + 1))) + 1))
        self.shift = np.uint64(64 - bits)
        edges = np.arange((1 << bits) + 1, dtype=np.uint64)
        tops = (self.hashes >> self.shift).astype(np.int64)
        self.start = np.searchsorted(tops, edges.astype(np.int64)).astype(np.int32)
        self.hashes = np.append(self.hashes, self.hashes[-1:] + np.uint64(1))  # a reading past the end is harmless

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Row of every packed key in the sorted array, -1 where it is absent."""
        out = np.full(len(keys), -1, np.int32)
        if self.size == 0 or len(keys) == 0:
            return out
        hashed = mix(keys)
        top = (hashed >> self.shift).astype(np.int64)
        at, end = self.start[top], self.start[top + 1]
        hit = (self.hashes[at] == hashed) & (at < end)
        out[hit] = at[hit]
        left = np.flatnonzero(~hit & (at + 1 < end))
        at = at[left] + 1
        while len(left):
            hit = self.hashes[at] == hashed[left]
            out[left[hit]] = at[hit]
            go = ~hit & (at + 1 < end[left])
            left, at = left[go], at[go] + 1
        return out
