"""Minimal perfect hash of one shard of 128-bit keys, in arrays.

Level by level every key left takes a place; keys alone on their place stay there, the
others go on to a smaller level. A key's slot is the number of taken places before its
own, so ``n`` keys have the slots 0 to ``n - 1``, at about three bits a key.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PLACES_PER_KEY = 2
MOST_LEVELS = 64                     # each halves what is left, or better

_ODD = np.random.default_rng(13).integers(0, 1 << 63, (2, MOST_LEVELS), dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys[:, 0] * _ODD[0, level] + keys[:, 1] * _ODD[1, level]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class PerfectHash:
    sizes: np.ndarray                # places of each level
    taken: np.ndarray                # whether a place is taken, level after level

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """Over distinct ``keys``, an array of two 64-bit halves a row."""
        sizes, taken, left = [], [], keys
        while len(left):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("keys repeat")
            size = max(8, len(left) * PLACES_PER_KEY)
            at = _places(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            taken.append(alone)
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(taken) if taken else np.empty(0, bool))

    @classmethod
    def read(cls, sizes: bytes, taken: bytes) -> PerfectHash:
        sizes = np.frombuffer(sizes, np.int64)
        return cls(sizes, np.unpackbits(np.frombuffer(taken, np.uint8), count=int(sizes.sum())).astype(bool))

    def stored(self) -> tuple[bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self.taken).tobytes()

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; of keys outside the set some slot or -1, so those need a check."""
        before = np.cumsum(self.taken) - 1
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = base + _places(keys[left], level, size)
            here = self.taken[at]
            out[left[here]] = before[at[here]]
            left, base = left[~here], base + size
        return out
