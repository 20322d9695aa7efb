"""Classes of equal substrings of one length, by threshold-bounded interval
expansion on a Burrows-Wheeler order. Works on one task's small batch of text."""

from __future__ import annotations

import numpy as np


def context_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``text`` (uint8) sorted by their next ``depth`` bytes or more,
    and the rank of every position. Bytes beyond the end count as zero."""
    n = len(text)
    padded = np.zeros(n + 8, dtype=np.uint64)
    padded[:n] = text
    key = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j:j + n]
    known = 8
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        step = np.empty(n, dtype=bool)
        step[:1] = False
        np.not_equal(ordered[1:], ordered[:-1], out=step[1:])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step)
        if known >= depth or (n and rank[order[-1]] == n - 1):
            return order, rank
        behind = np.zeros(n, dtype=np.uint64)
        if known < n:
            behind[:n - known] = rank[known:].astype(np.uint64) + np.uint64(1)
        key = (rank.astype(np.uint64) << np.uint64(32)) | behind
        known *= 2


def prefix_classes(text: np.ndarray, length: int) -> np.ndarray:
    """For every position, the class of the ``length`` bytes from it on: two
    positions have one class if these bytes are equal.

    Breadth-first over the common prefix: level k knows the intervals of
    positions that share k bytes. Every interval is extended backwards by the
    byte before its positions (the transform), all of them at once: two
    neighbours in the order share k + 1 bytes if their first bytes are equal
    and the positions behind them lie in one interval of level k. Level 0 is
    one interval; the search stops at ``length``, or when all intervals hold
    one position.
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int32)
    order, _ = context_order(text, length)
    place = np.empty(n, dtype=np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    # Where the position behind each one lies in the order; the end lies in no interval.
    behind = np.append(place[1:], np.int32(n))[order]
    first = text[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = first[1:] != first[:-1]
    interval = np.zeros(n + 1, dtype=np.int32)
    cut = np.ones(n, dtype=bool)
    for level in range(length):
        back = interval[behind]
        np.not_equal(back[1:], back[:-1], out=cut[1:])
        cut |= fresh
        np.cumsum(cut, out=interval[:n])
        interval[n] = -1  # nothing but the end shares a byte with the end
        if interval[n - 1] == n:
            break
    out = np.empty(n, dtype=np.int32)
    out[order] = interval[:n]
    return out
