"""Best-fit-decreasing bin packing of counted size classes.

Items of one size are interchangeable, and so are bins of one remaining capacity. So the exact
best-fit-decreasing result for any number of items follows from the histogram of sizes alone:
each class, largest first, goes to the tightest capacity that still holds it, `size // item`
items to a bin before the next bin is touched, just as item by item. The open capacities form
an ordered set searched by bisection (`TightBins`) or by a segment tree (`CapacityTree`).
A `Placement` says which ranks of a class go to which bins; ranks are dealt in Spark.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable
from typing import NamedTuple


class Placement(NamedTuple):
    """Ranks lo..hi-1 of class `size`: bin `bin + (rank - lo) // per_bin`, from `offset` on in it."""

    size: int
    lo: int
    hi: int
    bin: int
    per_bin: int
    offset: int


class TightBins:
    """Open runs of equal bins in a balanced order of remaining capacity."""

    def __init__(self):
        self.order: list[tuple[int, int, int]] = []  # remaining, first bin, number of bins

    def add(self, remaining: int, first: int, count: int) -> None:
        if count and remaining:
            insort(self.order, (remaining, first, count))

    def take(self, size: int) -> tuple[int, int, int] | None:
        at = bisect_left(self.order, (size, -1, -1))
        return self.order.pop(at) if at < len(self.order) else None


class CapacityTree:
    """Segment tree over the capacities 0..capacity: the smallest open one of at least a size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _count(self, remaining: int, change: int) -> None:
        node = self.leaves + remaining
        while node:
            self.open[node] += change
            node >>= 1

    def add(self, remaining: int, first: int, count: int) -> None:
        if count and remaining:
            self.runs.setdefault(remaining, []).append((first, count))
            self._count(remaining, 1)

    def take(self, size: int) -> tuple[int, int, int] | None:
        node = self.leaves + size
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        remaining = node - self.leaves
        first, count = self.runs[remaining].pop()
        self._count(remaining, -1)
        return remaining, first, count


def best_fit_decreasing(
    histogram: Iterable[tuple[int, int]], capacity: int, bins: int | None = None, tree: bool = False
) -> tuple[list[Placement], int] | None:
    """Placements and the number of bins, or None if `bins` bins don't hold all.

    `histogram` has (size, number of items), sizes from 1 to `capacity`.
    """
    store = CapacityTree(capacity) if tree else TightBins()
    out: list[Placement] = []
    used = 0
    for size, count in sorted(histogram, reverse=True):
        if size > capacity:
            return None
        rank = 0
        while rank < count:
            run = store.take(size)
            if run is None:
                fits = capacity // size
                fresh = -(-(count - rank) // fits)
                if bins is not None and used + fresh > bins:
                    return None
                run = (capacity, used, fresh)
                used += fresh
            remaining, first, n = run
            per_bin = remaining // size
            left = count - rank
            full = min(n, left // per_bin)
            if full:
                out.append(Placement(size, rank, rank + full * per_bin, first, per_bin, capacity - remaining))
                rank += full * per_bin
                store.add(remaining - per_bin * size, first, full)
            part = count - rank
            if full < n and part:  # fewer than a bin takes
                out.append(Placement(size, rank, count, first + full, per_bin, capacity - remaining))
                rank = count
                store.add(remaining - part * size, first + full, 1)
                full += 1
            store.add(remaining, first + full, n - full)
    return out, used


def even_bins(histogram: list[tuple[int, int]], bins: int) -> list[Placement]:
    """All items in exactly `bins` bins of nearly equal sums (at most one more each than needed).

    An item larger than an even share has a bin of its own while others share the rest. Then the
    least capacity at which best-fit-decreasing needs no more than the bins left is searched.
    """
    left = sorted((s, c) for s, c in histogram if c)
    out: list[Placement] = []
    taken: dict[int, int] = {}
    used = 0
    while left and used < bins - 1:
        size, count = left[-1]
        total = sum(s * c for s, c in left)
        if size * (bins - used) < total or size * (bins - used) == total and count == 1:
            break
        rank = taken.get(size, 0)
        out.append(Placement(size, rank, rank + 1, used, 1, 0))
        taken[size] = rank + 1
        used += 1
        left[-1:] = [(size, count - 1)] if count > 1 else []
    if not left:
        return out
    rest = bins - used
    total = sum(s * c for s, c in left)
    low = max(-(-total // rest), left[-1][0])
    high = low
    while (packed := best_fit_decreasing(left, high, rest)) is None:
        high += max(1, high // 8)
    while low < high:
        middle = (low + high) // 2
        trial = best_fit_decreasing(left, middle, rest)
        if trial is None:
            low = middle + 1
        else:
            high, packed = middle, trial
    for p in packed[0]:
        skip = taken.get(p.size, 0)
        out.append(p._replace(lo=p.lo + skip, hi=p.hi + skip, bin=p.bin + used))
    return out
