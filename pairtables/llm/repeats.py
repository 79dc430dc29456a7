"""Runs of many word sequences at once: dyadic blocks looked for in the windows next to them.

Sequences are laid one after the other, each word numbered within its sequence and each sequence
closed by a number of its own, so nothing matches across sequences. Substrings of length 2^k are
named by sorting (prefix doubling); the same sorting ends in the suffix array. A wavelet matrix
over the suffix array answers where, from a place on, a block next occurs.
"""

from __future__ import annotations

import numpy as np


def _names(symbols: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per level k: the first place in the suffix array of each substring of length 2^k, and how
    many suffixes start with it; and the suffix array. The last level has no equal substrings."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    firsts, counts, length = [], [], 1
    first = np.empty(n, dtype=np.int32)
    while True:
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, n))
        group = np.cumsum(new) - 1
        if not firsts:
            first[order] = heads[group]
            count = np.empty(n, dtype=np.int32)
            count[order] = sizes[group]
        firsts.append(first.copy())
        counts.append(count.copy())
        # Only suffixes that share their first 2^k words with another one are sorted further.
        slots = np.flatnonzero(sizes[group] > 1)
        if not len(slots):
            return firsts, counts, order
        at = order[slots]
        follow = at + length
        second = np.where(follow < n, first[np.minimum(follow, n - 1)], -1)
        key = first[at].astype(np.int64) * (n + 1) + second + 1
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[slots] = at
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        new[slots] = fresh
        heads = np.flatnonzero(fresh)
        sizes = np.diff(np.append(heads, len(at)))
        inner = np.cumsum(fresh) - 1
        first, count = first.copy(), count.copy()
        first[at] = slots[heads[inner]]
        count[at] = sizes[inner]
        length *= 2


class _Wavelet:
    """A wavelet matrix over numbers below 2^bits: how many are small in a range, and which is the c-th."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros_before, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            zero = (values >> bit) & 1 == 0
            self.zeros_before.append(np.concatenate(([0], np.cumsum(zero, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(self.zeros_before[-1][-1]))
            values = np.concatenate((values[zero], values[~zero]))

    def below(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many of the values at places ``low`` to ``high`` (exclusive) are below ``limit``."""
        all_ = limit >= 1 << self.bits
        low, high, found = low.copy(), high.copy(), np.zeros(len(low), dtype=np.int64)
        span = high - low
        for level, bit in enumerate(reversed(range(self.bits))):
            before, zeros = self.zeros_before[level], self.zeros[level]
            low_zero, high_zero = before[low], before[high]
            one = (limit >> bit) & 1 == 1
            found += np.where(one, high_zero - low_zero, 0)
            low = np.where(one, zeros + low - low_zero, low_zero)
            high = np.where(one, zeros + high - high_zero, high_zero)
        return np.where(all_, span, found)

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest value (from 0) at places ``low`` to ``high`` (exclusive)."""
        low, high, k = low.copy(), high.copy(), k.copy()
        value = np.zeros(len(low), dtype=np.int64)
        for level, bit in enumerate(reversed(range(self.bits))):
            before, zeros = self.zeros_before[level], self.zeros[level]
            low_zero, high_zero = before[low], before[high]
            n_zero = high_zero - low_zero
            one = k >= n_zero
            value |= np.where(one, 1 << bit, 0)
            k = np.where(one, k - n_zero, k)
            low = np.where(one, zeros + low - low_zero, low_zero)
            high = np.where(one, zeros + high - high_zero, high_zero)
        return value


def _forward(firsts: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols from ``i`` on equal those from ``j`` on (j > i); the names give it in halving steps."""
    n, start = len(firsts[0]), i
    i, j = i.copy(), j.copy()
    for level in reversed(range(len(firsts))):
        name = firsts[level]
        while True:
            inside = j < n
            same = inside & (name[np.where(inside, i, 0)] == name[np.where(inside, j, 0)])
            if not same.any():
                break
            i[same] += 1 << level
            j[same] += 1 << level
            if level < len(firsts) - 1:
                break  # a second step of this length would be one of the level above
    return i - start


def _backward(firsts: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols that end with ``i`` equal those that end with ``j`` (j > i)."""
    start = i
    i, j = i.copy(), j.copy()
    for level in reversed(range(len(firsts))):
        name, size = firsts[level], 1 << level
        while True:
            low, high = i - size + 1, j - size + 1
            inside = low >= 0
            same = inside & (name[np.where(inside, low, 0)] == name[np.where(inside, high, 0)])
            if not same.any():
                break
            i[same] -= size
            j[same] -= size
            if level < len(firsts) - 1:
                break
    return start - i


def runs(symbols: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (exclusive) and smallest period q of every maximal stretch of period q that is
    at least ``max(least, times * q)`` long, by start and period; ``times`` is 4 or more.

    A run of period q, with m = 2^k <= q < 2m, holds a block of m symbols at a multiple of m that
    occurs again q later, inside the run. So each block asks for its occurrences that start m to
    2m - 1 later. Up to two of them are candidate periods. Three or more are a progression whose
    step d is the block's own period; then the block lies in a stretch of period d, its later
    occurrences in another one (or in the same, and then q is no smallest period), and a run that
    holds both maps the start of the first stretch to that of the second, or its end to its end:
    two candidates again. Each candidate is extended both ways and kept if it is long enough.
    """
    if len(symbols) < least:
        return (np.empty(0, dtype=np.int64),) * 3
    firsts, counts, order = _names(symbols)
    wavelet = _Wavelet(order)
    places, periods = [], []
    for level, (first, count) in enumerate(zip(firsts, counts)):
        m = 1 << level
        block = np.arange(0, len(symbols), m)
        block = block[count[block] > 1]
        if not len(block):
            continue
        low = first[block].astype(np.int64)
        high = low + count[block]
        smaller = wavelet.below(low, high, block + m)
        # The next one that is not smaller, if there is any; most blocks have none near.
        some = smaller < high - low
        block, low, high, smaller = block[some], low[some], high[some], smaller[some]
        next_ = wavelet.kth(low, high, smaller)
        near = next_ < block + 2 * m
        block, low, high, smaller, next_ = block[near], low[near], high[near], smaller[near], next_[near]
        places.append(block)
        periods.append(next_ - block)
        n_near = wavelet.below(low, high, block + 2 * m) - smaller
        two = n_near >= 2
        block, low, high, smaller, next_, n_near = (x[two] for x in (block, low, high, smaller, next_, n_near))
        second = wavelet.kth(low, high, smaller + 1)
        places.append(block[n_near == 2])
        periods.append((second - block)[n_near == 2])
        many = n_near > 2
        block, next_, step = block[many], next_[many], (second - next_)[many]
        ends = [at + step + _forward(firsts, at, at + step) for at in (block, next_)]
        starts = [at - _backward(firsts, at - 1, at + step - 1) for at in (block, next_)]
        for one, other in (starts, ends):
            places.append(block)
            periods.append(other - one)
    place, period = np.concatenate(places), np.concatenate(periods)
    place, period = place[period > 0], period[period > 0]
    fits = place + period < len(symbols)
    place, period = place[fits], period[fits]
    start = place - _backward(firsts, place - 1, place + period - 1)
    end = place + period + _forward(firsts, place, place + period)
    long = end - start >= np.maximum(least, times * period)
    start, end, period = start[long], end[long], period[long]
    # The same stretch may be found with multiples of its period: keep the smallest.
    sort = np.lexsort((period, end, start))
    start, end, period = start[sort], end[sort], period[sort]
    kept = np.ones(len(start), dtype=bool)
    kept[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[kept], end[kept], period[kept]
    sort = np.lexsort((period, start))
    return start[sort], end[sort], period[sort]
