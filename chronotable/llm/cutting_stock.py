"""Cutting stock by column generation, on a histogram of sizes.

Pieces of a few sizes are to be cut from as few rolls of ``capacity`` as possible. A pattern says how many pieces of each
size a roll gives. The linear program over patterns keeps one basis of as many patterns as there are sizes;
its dual prices say what a piece of each size is worth, and the pattern of most worth is found by
dynamic programming over the capacity (an unbounded knapsack). A pattern worth more than a roll enters the basis; if
there is none, the program is solved. Whole numbers of each pattern are taken, and the few pieces left, fewer than
the patterns hold, are put into rolls by size. All of it depends on the number of sizes, never on that of pieces.
"""

from __future__ import annotations

import numpy as np

Pattern = dict[int, int]  # pieces by size


def _best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of most worth."""
    worth = np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.flatnonzero(sizes <= room)
        worth[room], chosen[room] = worth[room - 1], -1
        if len(fits):
            values = worth[room - sizes[fits]] + prices[fits]
            k = int(values.argmax())
            if values[k] > worth[room] + 1e-12:
                worth[room], chosen[room] = values[k], fits[k]
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            counts[chosen[room]] += 1
            room -= int(sizes[chosen[room]])
    return float(worth[capacity]), counts


def relaxed(histogram: Pattern, capacity: int, rounds: int = 3_000) -> list[tuple[float, Pattern]]:
    """Rolls by pattern, as fractions, that cover the histogram with the fewest rolls."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n > 0))
    if not len(sizes):
        return []
    need = np.array([histogram[int(s)] for s in sizes], float)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / np.diag(columns))
    amounts = inverse @ need
    for _ in range(rounds):
        prices = inverse.sum(axis=0)
        worth, pattern = _best_pattern(np.maximum(prices, 0), sizes, capacity)
        if worth <= 1 + 1e-9:
            break
        entering = inverse @ pattern
        able = entering > 1e-10
        ratios = np.where(able, amounts / np.where(able, entering, 1), np.inf)
        leaving = int(ratios.argmin())
        step = ratios[leaving]
        amounts -= step * entering
        amounts[leaving] = step
        columns[:, leaving] = pattern
        inverse[leaving] /= entering[leaving]
        others = np.arange(len(sizes)) != leaving
        inverse[others] -= np.outer(entering[others], inverse[leaving])
        amounts = np.maximum(amounts, 0)
    return [(float(x), {int(s): int(c) for s, c in zip(sizes, column, strict=True) if c}) for x, column in zip(amounts, columns.T, strict=True) if x > 1e-9]


def cut(histogram: Pattern, capacity: int) -> list[tuple[int, Pattern]]:
    """Whole numbers of rolls by pattern; together exactly the pieces of the histogram."""
    left = {s: n for s, n in histogram.items() if n > 0}
    rolls: list[tuple[int, Pattern]] = []
    for amount, pattern in sorted(relaxed(histogram, capacity), key=lambda x: -x[0]):
        times = min([int(amount + 1e-6), *(left[s] // c for s, c in pattern.items())])
        if times > 0:
            rolls.append((times, pattern))
            for s, c in pattern.items():
                left[s] -= times * c
    while any(left.values()):
        room, pattern = capacity, {}
        for size in sorted((s for s, n in left.items() if n), reverse=True):
            c = min(left[size], room // size)
            if c:
                pattern[size] = c
                room -= c * size
        times = min(left[s] // c for s, c in pattern.items())
        rolls.append((times, pattern))
        for s, c in pattern.items():
            left[s] -= times * c
    return rolls
