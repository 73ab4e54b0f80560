"""A minimal perfect hash over 128-bit keys, as flat arrays.

Level by level, each key that is left sets one bit of a bit array; keys that are alone on their bit stay there, the others
go on to the next level. A key's place is the number of bits set before its own, so n keys take the places 0 to n - 1 and
the levels need about 3 bits a key. What the keys carry lies in arrays in the order of the places, next to the second half
of each key as its fingerprint: a lookup of a key that was never put in finds another fingerprint.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from harmlens.llm.batches import U64, mix

SPREAD = 2  # bits of a level for each key that is left


def _bit(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = U64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(first + mix(second ^ seed)) % U64(size)).astype(np.int64)


@dataclass
class Index:
    """Bits of all levels in a row, where each level begins, set bits before each byte, fingerprints, and carried arrays."""

    bits: np.ndarray
    begins: np.ndarray
    before: np.ndarray
    prints: np.ndarray
    carried: list[np.ndarray]

    def __len__(self) -> int:
        return len(self.prints)

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Place of each key; -1 for keys that are not in the index."""
        place = _places(self.bits, self.begins, self.before, first, second)
        found = np.flatnonzero(place >= 0)
        place[found[self.prints[place[found]] != second[found]]] = -1
        return place

    def written(self) -> list[bytes]:
        return [a.tobytes() for a in (self.bits, self.begins, self.before, self.prints, *self.carried)]

    @staticmethod
    def read(parts: list[bytes], kinds: list[str]) -> Index:
        """What ``written`` gave, with the types of the carried arrays."""
        bits, begins, before, prints, *rest = (np.frombuffer(p, dtype=k) for p, k in zip(parts, ["u1", "i8", "u4", "u8", *kinds]))
        return Index(bits, begins, before, prints, rest)


_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def _places(bits: np.ndarray, begins: np.ndarray, before: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Number of set bits before the first one that a key meets; -1 where it meets none."""
    out, left = np.full(len(first), -1, dtype=np.int64), np.arange(len(first))
    for level in range(len(begins) - 1):
        at = begins[level] + _bit(first[left], second[left], level, int(begins[level + 1] - begins[level]))
        byte, mask = bits[at >> 3], (0x80 >> (at & 7)).astype(np.uint8)
        hit = (byte & mask) != 0
        ahead = byte & ~(mask | (mask - np.uint8(1)))  # the bits of this byte before the key's own
        out[left[hit]] = (before[at >> 3] + _ONES[ahead])[hit]
        left = left[~hit]
    return out


def build(first: np.ndarray, second: np.ndarray, *carried: np.ndarray) -> Index:
    """An index of distinct keys (two halves) and what they carry."""
    taken, begins, left, level = [], [0], np.arange(len(first)), 0
    while len(left):
        size = -(-SPREAD * len(left) // 8) * 8
        bit = _bit(first[left], second[left], level, size)
        times = np.bincount(bit, minlength=size)
        taken.append(times == 1)
        left = left[times[bit] > 1]
        begins.append(begins[-1] + size)
        level += 1
    bits = np.packbits(np.concatenate(taken)) if taken else np.zeros(0, np.uint8)
    before = np.concatenate([[0], np.cumsum(_ONES[bits])])[:-1].astype(np.uint32)
    levels = np.array(begins, dtype=np.int64)
    order = np.argsort(_places(bits, levels, before, first, second))
    return Index(bits, levels, before, second[order], [c[order] for c in carried])
