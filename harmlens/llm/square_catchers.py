"""Runs of a growing sequence by dyadic square catching.

Each completed block of ``l`` = 1, 2, 4, ... words is a catcher for the periods from 2l up to 4l (blocks of one word
also for period 1): it waits for its own words to come back at one of these distances. The first half of a square
of such a period always holds a whole aligned block of l words, so every square is caught. Appending words completes
new windows, and each is compared with the two blocks whose distances fit, by hashes. What a catcher catches is
carried on to both sides by suffix comparisons in halving steps. A stretch that still agrees with itself at the end of
the sequence stays open and is carried on by the next words. Squares of one period that touch merge into one run, and
of several periods of the same stretch the smallest counts.

Appending n words takes O(n log n) steps, done for all new windows of a block length at once; the memory is linear.
Windows are compared by a 64-bit polynomial hash, what agrees also by one modulo a prime.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from harmlens.llm.batches import U64

FACTOR = 0x9E3779B97F4A7C15
PRIME = (1 << 31) - 1
PRIME_FACTOR = 1_103_515_245


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of FACTOR, of its inverse, and of PRIME_FACTOR modulo PRIME."""
    up, down, prime = (np.ones(1, dtype=np.uint64) for _ in range(3))
    for k in range(bits):
        up = np.concatenate([up, up * U64(pow(FACTOR, 1 << k, 1 << 64))])
        down = np.concatenate([down, down * U64(pow(FACTOR, -(1 << k), 1 << 64))])
        prime = np.concatenate([prime, prime * U64(pow(PRIME_FACTOR, 1 << k, PRIME)) % U64(PRIME)])
    return up, down, prime


class SquareCatchers:
    """Runs of at least ``shortest`` words, and of two periods, in the words appended so far.

    Words are 64-bit codes, equal only for equal words. ``reach``, where given, says for a period how many words of
    the sequence can hold a run of that period or a larger one; the rest is not searched for it.
    """

    def __init__(self, shortest: int = 12, reach=None):
        self.shortest = shortest
        self.reach = reach or (lambda period: self.n)
        self.n = 0
        self.searched: dict[int, int] = {}  # words searched by the catchers of a length
        self.sums = np.zeros(1, dtype=np.uint64)
        self.prime_sums = np.zeros(1, dtype=np.uint64)
        # stretches [start, stop) whose words equal those ``period`` further on: complete squares, and open ones
        self.period = self.start = self.stop = np.zeros(0, dtype=np.int64)

    def append(self, codes: np.ndarray) -> None:
        if not len(codes):
            return
        old, self.n = self.n, self.n + len(codes)
        up, down, prime = self.powers = _powers(max(16, self.n.bit_length()))
        add = lambda sums, more: np.concatenate([sums, sums[-1] + np.cumsum(more, dtype=np.uint64)])
        self.sums = add(self.sums, codes * up[old : self.n])
        self.prime_sums = add(self.prime_sums, codes % U64(PRIME) * prime[old : self.n] % U64(PRIME))
        caught = [(self.period, self.start, self.stop + self._agreeing(self.stop, self.period, len(codes), ahead=True))]
        length = 1
        while (words := min(self.n, self.reach(2 * length if length > 1 else 1))) >= max(4 * length, self.shortest):
            caught.append(self._catch(self.searched.get(length, 0), words, length))
            self.searched[length] = words
            length *= 2
        self._merge(*(np.concatenate(part) for part in zip(*caught)))

    def _catch(self, old: int, n: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches that hold a block of ``length`` words and, at a fitting distance, a window that is new since ``old``."""
        down = self.powers[1]
        first = max(0, max(0, old - length + 1) // length - 3)  # block row of the oldest catcher concerned
        low, windows = first * length, n - length + 1
        rows = np.zeros(-(-(windows - low) // length) * length, dtype=np.uint64)
        held = rows[: windows - low]
        np.subtract(self.sums[low + length : n + 1], self.sums[low:windows], out=held)
        held *= down[low:windows]
        rows = rows.reshape(-1, length)
        blocks = rows[:, 0]
        starts, periods = [], []
        for back in (1, 2, 3) if length == 1 else (2, 3):
            row, shift = np.nonzero(rows[back:] == blocks[: max(0, len(blocks) - back), None])
            starts.append((row + first) * length)
            periods.append(back * length + shift)
        start, period = np.concatenate(starts), np.concatenate(periods)
        use = start + period < windows
        start, period = start[use], period[use]
        use = self._equal_by_prime(start, period, np.full(len(start), length))
        start, period = start[use], period[use]
        # blocks in a row that agree at one distance are one stretch
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + length)
        head = np.flatnonzero(fresh)
        stop = start[np.append(head[1:], len(start))[: len(head)] - 1] + length
        start, period = start[head], period[head]
        # less than a block is left on either side, or it would have been caught
        return period, start - self._agreeing(start, period, length - 1, ahead=False), stop + self._agreeing(stop, period, length - 1, ahead=True)

    def _agreeing(self, at: np.ndarray, period: np.ndarray, most: int, ahead: bool) -> np.ndarray:
        """How many words from ``at`` on (or before it) equal those ``period`` further on; ``most`` or fewer."""
        found = np.zeros(len(at), dtype=np.int64)
        step = 1 << max(0, most.bit_length() - 1) if most else 0
        while step and len(at):
            begin = at + found if ahead else at - found - step
            inside = (begin >= 0) & (begin + period + step <= self.n)
            safe, shift, size = np.where(inside, begin, 0), np.where(inside, period, 0), np.where(inside, step, 0)
            same = (self.sums[safe + size] - self.sums[safe]) * self.powers[0][shift] == self.sums[safe + shift + size] - self.sums[safe + shift]
            found += step * (inside & same & self._equal_by_prime(safe, shift, size))
            step >>= 1
        return found

    def _equal_by_prime(self, start: np.ndarray, period: np.ndarray, size: np.ndarray) -> np.ndarray:
        sums, p = self.prime_sums, U64(PRIME)
        here = (sums[start + size] - sums[start]) % p * self.powers[2][period] % p
        return here == (sums[start + period + size] - sums[start + period]) % p

    def _merge(self, period: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        order = np.lexsort((start, period))
        period, start, stop = period[order], start[order], stop[order]
        base = period * (self.n + 1)
        last = np.maximum.accumulate(base + stop) if len(stop) else base
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (base + start)[1:] > last[:-1]
        head = np.flatnonzero(fresh)
        stop = (last - base)[np.append(head[1:], len(start))[: len(head)] - 1]
        period, start = period[head], start[head]
        wanted = (stop - start + period >= np.maximum(self.shortest, 2 * period)) | (stop + period == self.n)
        self.period, self.start, self.stop = period[wanted], start[wanted], stop[wanted]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and smallest period of every run, by start, then period."""
        length = self.stop - self.start + self.period
        whole = length >= np.maximum(self.shortest, 2 * self.period)
        start, length, period = self.start[whole], length[whole], self.period[whole]
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        fresh = np.ones(len(start), dtype=bool)
        fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[fresh], length[fresh], period[fresh]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]
