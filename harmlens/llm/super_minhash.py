"""SuperMinHash signatures of many sets at once.

Every element draws a random permutation of the signature's slots and a random fraction for each rank.
A slot keeps the least rank plus fraction any element gives it. Ranks are drawn one after the other, for
all elements of all unfinished sets together; a set is finished as soon as no slot holds a higher rank than
the last one drawn, which for large sets is after the first draw.
"""

from __future__ import annotations

import numpy as np

from harmlens.llm.batches import U64, mix

UNSET = np.uint32(0xFFFFFFFF)
CHUNK = 1 << 16  # elements of unfinished sets that hold a permutation at the same time


def _draw(elements: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """A choice (32 bits) and a fraction (24 bits) of each element at a rank."""
    bits = mix(elements + U64((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return bits >> U64(32), (bits & U64(0xFFFFFF)).astype(np.uint32)


def signatures(elements: np.ndarray, row: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """``(rows, slots)`` signatures; ``row`` of each element ascends. An empty set stays unset everywhere."""
    if slots > 255:
        raise ValueError("ranks have 8 bits")
    out = np.full((rows, slots), UNSET, dtype=np.uint32)
    flat = out.reshape(-1)
    choice, fraction = _draw(elements, 0)
    slot = (choice * U64(slots) >> U64(32)).astype(np.int64)
    np.minimum.at(flat, row * slots + slot, fraction)
    counts = np.bincount(row, minlength=rows)
    begin = np.concatenate([[0], np.cumsum(counts)])
    open_rows = np.flatnonzero((counts > 0) & (out.max(axis=1, initial=0) >> 24 > 0))
    at = 0
    while at < len(open_rows):
        stop = max(at + 1, int(np.searchsorted(np.cumsum(counts[open_rows[at:]]), CHUNK)) + at)
        _finish(out, elements, begin, open_rows[at:stop], slots)
        at = stop
    return out


def _finish(out: np.ndarray, elements: np.ndarray, begin: np.ndarray, rows: np.ndarray, slots: int) -> None:
    """The ranks after the first, for rows that need them."""
    index = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in rows])
    local = np.repeat(np.arange(len(rows)), begin[rows + 1] - begin[rows])
    own = elements[index]
    part = out[rows]
    flat = part.reshape(-1)
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(own), 1))
    i = np.arange(len(own))
    choice, _ = _draw(own, 0)
    picked = (choice * U64(slots) >> U64(32)).astype(np.int64)
    order[i, picked] = order[i, 0]
    for rank in range(1, slots):
        choice, fraction = _draw(own[i], rank)
        picked = rank + (choice * U64(slots - rank) >> U64(32)).astype(np.int64)
        slot = order[i, picked]
        order[i, picked] = order[i, rank]
        np.minimum.at(flat, local[i] * slots + slot, np.uint32(rank << 24) | fraction)
        unfinished = part.max(axis=1) >> 24 > rank
        i = i[unfinished[local[i]]]
        if not len(i):
            break
    out[rows] = part


def band_keys(signature: np.ndarray, rows_per_band: int) -> np.ndarray:
    """One 64-bit key per band of each signature; different bands never share keys on purpose."""
    bands = signature.shape[1] // rows_per_band
    parts = signature[:, : bands * rows_per_band].reshape(len(signature), bands, rows_per_band).astype(np.uint64)
    keys = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + U64(0xA0761D6478BD642F)), (len(signature), bands)).copy()
    for k in range(rows_per_band):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys
