"""Rank statistics over all pairs of a series in n log n steps, without making the pairs."""

import numpy as np


def _pairs_below(rank, bound):
    """How many pairs i < j have rank[i] < bound[j]: blocks of doubling width, each right one looked up in its left one."""
    n, total, width = len(rank), 0, 1
    at = np.arange(n)
    while width < n:
        block = at // width
        ordered = np.sort(block * (n + 1) + rank)
        right = (block & 1) == 1
        left = block[right] - 1
        total += int((np.searchsorted(ordered, left * (n + 1) + bound[right]) - left * width).sum())
        width *= 2
    return total


def _ranked(x):
    order = np.argsort(x, kind="stable")
    rank = np.empty(len(x), dtype=np.int64)
    rank[order] = np.arange(len(x))
    return rank, x[order]


def sign_sum(x: np.ndarray, unit: float) -> int:
    """Sum of the signs of x[j] - x[i] over all i < j, differences rounded to ``unit`` first."""
    n = len(x)
    rank, ordered = _ranked(x)
    rises = _pairs_below(rank, np.searchsorted(ordered, x - unit / 2, side="right"))
    not_falling = _pairs_below(rank, np.searchsorted(ordered, x + unit / 2, side="left"))
    return rises + not_falling - n * (n - 1) // 2


def _slopes_up_to(x, t):
    """How many of the slopes between pairs of x are at most t."""
    level = x - t * np.arange(len(x))
    rank, ordered = _ranked(level)
    return len(x) * (len(x) - 1) // 2 - _pairs_below(rank, np.searchsorted(ordered, level, side="left"))


def _slope_of_rank(x, k):
    """The k-th smallest slope (from 1), to 1e-13 of the largest slope, by halving the range of slopes."""
    steps = np.diff(x)  # every slope is a mean of these
    low, high = float(steps.min()), float(steps.max())
    if _slopes_up_to(x, low) >= k:
        return low
    exact = 1e-13 * max(abs(low), abs(high))
    while high - low > exact:
        t = (low + high) / 2
        if not low < t < high:
            break
        low, high = (low, t) if _slopes_up_to(x, t) >= k else (t, high)
    return high


def median_slope(x: np.ndarray) -> float:
    """Median of (x[j] - x[i]) / (j - i) over all i < j; NaN for fewer than two values."""
    pairs = len(x) * (len(x) - 1) // 2
    if not pairs:
        return float("nan")
    low = _slope_of_rank(x, (pairs + 1) // 2)
    if pairs % 2 or _slopes_up_to(x, low) > pairs // 2:
        return low + 0.0
    return (low + _slope_of_rank(x, pairs // 2 + 1)) / 2
