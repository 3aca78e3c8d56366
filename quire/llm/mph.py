"""A minimal perfect hash of 128-bit keys, with an entry array per value.

Each level hashes the keys that are left into twice as many bits; keys alone on their
bit stay there, the others go on to the next level. A key's index is the rank of its bit.
The few keys left after LEVELS levels are kept sorted. What is not a key may reach an
index too, so each index also holds the key's second half as fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEVELS = 24


def _bits(first: np.ndarray, level: int, size: int) -> np.ndarray:
    x = first ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    levels: list[np.ndarray]
    rest: np.ndarray

    @property
    def size(self) -> int:
        return sum(int(x.sum()) for x in self.levels) + len(self.rest)

    def index(self, first: np.ndarray) -> np.ndarray:
        """Index of each key by its first half, -1 for what is certainly none."""
        out = np.full(len(first), -1, dtype=np.int64)
        left, base = np.arange(len(first)), 0
        for level, bits in enumerate(self.levels):
            at = _bits(first[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = base + np.cumsum(bits)[at[hit]] - 1
            left, base = left[~hit], base + int(bits.sum())
        if len(self.rest) and len(left):
            at = np.minimum(np.searchsorted(self.rest, first[left]), len(self.rest) - 1)
            hit = self.rest[at] == first[left]
            out[left[hit]] = base + at[hit]
        return out

    def pack(self) -> tuple[list[int], list[bytes], bytes]:
        return [len(x) for x in self.levels], [np.packbits(x).tobytes() for x in self.levels], self.rest.tobytes()

    @staticmethod
    def unpack(sizes, bits, rest) -> PerfectHash:
        levels = [np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool) for n, b in zip(sizes, bits)]
        return PerfectHash(levels, np.frombuffer(rest, dtype=np.uint64))


def build(first: np.ndarray) -> PerfectHash:
    """Of distinct first halves."""
    levels, left = [], first.astype(np.uint64)
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(64, 2 * len(left))
        at = _bits(left, level, size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return PerfectHash(levels, np.sort(left))
