"""Equal pieces of a merge of two ascending arrays (merge path, Green et al. 2012), walked side by side."""

from __future__ import annotations

import numpy as np

#: Steps of one piece, a step taking one value of either array.
PIECE = 512


def split_points(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first ``d`` values of the merge come from ``a``, for every diagonal ``d``.

    Of equal values that of ``a`` comes first. One binary search per diagonal, none of which
    needs another's result.
    """
    low = np.maximum(diagonals - len(b), 0)
    high = np.minimum(diagonals, len(a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        at_a, at_b = middle[open_], (diagonals - 1 - middle)[open_]
        first = a[at_a] <= b[at_b]
        low[open_] = np.where(first, at_a + 1, low[open_])
        high[open_] = np.where(first, high[open_], at_a)
    return low


def common_values(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both hold; each array ascends strictly.

    All pieces take a step at a time together. A value of ``b`` equals one of ``a`` only if that
    was the last taken from ``a``; at the start of a piece this is the value just before its
    split point, which joins a pair that a diagonal has cut in two.
    """
    total = len(a) + len(b)
    starts = np.arange(0, total, piece, dtype=np.int64)
    i = split_points(a, b, starts)
    j = starts - i
    left = np.minimum(piece, total - starts)
    # One value above all others after each array, one below all others before ``a``.
    top = max(a[-1] if len(a) else 0, b[-1] if len(b) else 0) + 1
    before_a = np.concatenate(([-1], a, [top]))
    padded_b = np.concatenate((b, [top]))
    partner = np.full(len(b) + 1, -1, dtype=np.int64)
    for step in range(min(piece, total)):
        if step == left[-1]:  # only the last piece may be shorter
            i, j = i[:-1], j[:-1]
        next_b = padded_b[j]
        from_a = before_a[i + 1] <= next_b
        # A value past the end of both never comes up: a piece ends where the arrays end.
        hit = ~from_a & (before_a[i] == next_b)
        partner[j[hit]] = i[hit] - 1
        i += from_a
        j += ~from_a
    at_b = np.flatnonzero(partner[:-1] >= 0)
    return partner[at_b], at_b
