"""Cutting stock by column generation, for a histogram of piece lengths.

The histogram has at most ``capacity`` different lengths whatever the corpus
size, so this runs on the driver: a linear program over patterns (how many
pieces of each length class go into one sequence), whose columns are priced by
a knapsack dynamic program, and a rounding step for the fractional rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Length classes of the linear program; a class takes the room of its longest piece.
MAX_CLASSES = 256
#: Column generation ends when the bound shows that at most this share (or one sequence) is left to gain.
GAP = 0.002
MAX_PIVOTS = 2000
#: Knapsacks solved at most; the bound usually ends the search long before.
MAX_KNAPSACKS = 300
#: Weight of the full-sequence duals when a column is priced.
SMOOTHING = 0.8


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that each hold ``items`` = ((class, copies), ...)."""
    items: tuple[tuple[int, int], ...]
    times: int


def length_classes(lengths: np.ndarray, counts: np.ndarray, k: int = MAX_CLASSES) -> np.ndarray:
    """Class of every length (ascending). With more than ``k`` lengths, dense
    regions get narrower classes (density of classes ~ square root of the counts)."""
    if len(lengths) <= k:
        return np.arange(len(lengths))
    weight = np.cumsum(np.sqrt(counts))
    cls = np.minimum((weight - np.sqrt(counts)) * k / weight[-1], k - 1).astype(np.int64)
    return np.unique(cls, return_inverse=True)[1]


def knapsack(sizes: np.ndarray, values: np.ndarray, limits: np.ndarray, capacity: int,
             eps: float = 1e-12) -> np.ndarray:
    """Copies of each item with the greatest value within ``capacity``; at most
    ``limits`` of each. Dynamic program over the room, items split into powers of two."""
    best = np.zeros(capacity + 1)
    lots = []
    for i in np.flatnonzero(values > eps):
        left, lot, size, value = int(min(limits[i], capacity // sizes[i])), 1, int(sizes[i]), values[i]
        while left > 0 and min(lot, left) * size <= capacity:
            lot = min(lot, left)
            lots.append((i, lot, best.copy()))
            np.maximum(best[lot * size:], lots[-1][2][:-lot * size] + lot * value, out=best[lot * size:])
            left, lot = left - lot, lot * 2
    copies = np.zeros(len(sizes), dtype=np.int64)
    at = int(np.argmax(best))
    value = best[at]
    for i, lot, before in reversed(lots):
        if before[at] < value - eps:
            copies[i] += lot
            at -= lot * int(sizes[i])
            value = before[at]
    return copies


def linear_program(sizes: np.ndarray, demand: np.ndarray, capacity: int, pool: np.ndarray,
                   gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Fractional optimum: columns (patterns) of the last basis and their use.

    Revised simplex: the basis starts with one-class patterns. Duals price the
    next column: the best of ``pool`` (columns known beforehand) while one
    improves the basis, then the result of a knapsack. The duals are smoothed towards ``sizes /
    capacity``, which no pattern can exceed, so that priced patterns are full
    ones from the start. The search ends at the bound that full sequences
    give, or when no column improves the basis.
    """
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ demand
    full = sizes / capacity
    least = float(full @ demand)
    knapsacks = 0
    for _ in range(MAX_PIVOTS):
        if knapsacks >= MAX_KNAPSACKS or use.sum() - least <= max(gap * least, 1.0):
            break
        duals = inverse.sum(axis=0)
        known = duals @ pool
        if known.size and known.max() > 1 + gap:
            smoothings, column = (), pool[:, int(np.argmax(known))]
        else:
            smoothings = (SMOOTHING, 0.0)
        for smooth in smoothings:
            knapsacks += 1
            column = knapsack(sizes, smooth * full + (1 - smooth) * duals, demand, capacity).astype(float)
            price = float(duals @ column)
            if price > 1 + gap:
                break
        else:
            if smoothings:
                break
        step = inverse @ column
        ok = step > 1e-9
        if not ok.any():
            break
        ratio = np.full(m, np.inf)
        ratio[ok] = use[ok] / step[ok]
        out = int(np.argmin(ratio))
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        use = use - ratio[out] * step
        use[out] = ratio[out]
    return basis.astype(np.int64), np.maximum(use, 0.0)


def fill_rest(sizes: np.ndarray, rest: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns without the linear program: the longest piece first, the room
    beside it filled as full as a knapsack over the remaining pieces can."""
    rest = rest.copy()
    out = []
    while rest.any():
        first = int(np.flatnonzero(rest)[-1])
        rest[first] -= 1
        copies = knapsack(sizes, sizes * (rest > 0), rest, int(capacity - sizes[first]), 1e-6)
        rest[first] += 1
        copies[first] += 1
        times = int(np.min(rest[copies > 0] // copies[copies > 0]))
        rest -= times * copies
        out.append(_pattern(copies, times))
    return out


def _pattern(copies: np.ndarray, times: int) -> Pattern:
    return Pattern(tuple((int(i), int(copies[i])) for i in np.flatnonzero(copies)), int(times))


def cutting_plan(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[Pattern]:
    """Whole patterns that hold exactly ``demand`` pieces of every class: the
    rounded linear program and a filled rest, or, if that takes fewer sequences
    (small inputs, where rounding weighs most), the filled patterns that the
    program started from."""
    if not len(sizes):
        return []
    greedy = fill_rest(sizes, demand.astype(np.int64), capacity)
    pool = np.zeros((len(sizes), len(greedy)))
    for j, p in enumerate(greedy):
        for i, copies in p.items:
            pool[i, j] = copies
    columns, use = linear_program(sizes, demand, capacity, pool)
    plan, rest = [], demand.astype(np.int64).copy()
    for j in np.argsort(-use, kind="stable"):
        copies = columns[:, j]
        times = int(np.floor(use[j] + 1e-7))
        if times and copies.any():
            times = min(times, int(np.min(rest[copies > 0] // copies[copies > 0])))
        if times > 0 and copies.any():
            rest -= times * copies
            plan.append(_pattern(copies, times))
    plan += fill_rest(sizes, rest, capacity)
    return min(plan, greedy, key=lambda patterns: sum(p.times for p in patterns))
