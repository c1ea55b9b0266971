"""Least-cost flow from patterns to quotas, as whole-array work over the (pattern, source) cells.

Each pattern may give its words several times, and every further use costs more (any convex cost).
The feasible totals of the patterns form a polymatroid, so one vector of totals is best for every
such cost at once: the one whose uses (words given by words there are) are as even as the cells
allow. It is found by raising one common use for all patterns until some set of sources is full;
the patterns that can reach no other source stay at that use, and the rest rise on. There are at
most as many such steps as sources, and their sizes follow from minimum cuts, so neither the number
of patterns nor that of uses is limited.
"""

from __future__ import annotations

import numpy as np

#: Half a word: less is not worth moving.
EPS = 0.5


def _filled(amounts: np.ndarray, total: float) -> np.ndarray:
    """The amounts, in order, as far as they sum up to `total`."""
    return np.clip(total - (np.cumsum(amounts) - amounts), 0.0, amounts)


class _Flow:
    """Flow over cells sorted by source; `of` lists the cells of a source, its patterns ascending."""

    def __init__(self, pattern: np.ndarray, source: np.ndarray, room: np.ndarray, quota: np.ndarray, n_patterns: int):
        self.pattern, self.source, self.room, self.n = pattern, source, room, n_patterns
        starts = np.searchsorted(source, np.arange(len(quota) + 1))
        self.of = [slice(a, b) for a, b in zip(starts[:-1], starts[1:])]
        self.flow = np.zeros(len(pattern))
        self.left = quota.astype(float).copy()
        self.supply = np.zeros(n_patterns)

    def state(self) -> tuple:
        return self.flow.copy(), self.left.copy()

    def restore(self, state: tuple) -> None:
        self.flow, self.left = state[0].copy(), state[1].copy()

    def given(self) -> np.ndarray:
        """Words each pattern gives."""
        return np.bincount(self.pattern, self.flow, self.n)

    def _push(self, s: int, total: float | None = None) -> float:
        """From open supplies into a source: as much as it takes, or `total`."""
        cells = self.of[s]
        p = self.pattern[cells]
        most = np.minimum(self.supply[p], self.room[cells] - self.flow[cells])
        add = _filled(np.maximum(most, 0.0), self.left[s] if total is None else total)
        self.flow[cells] += add
        self.supply[p] -= add
        self.left[s] -= add.sum()
        return float(add.sum())

    def _hop(self, s: int, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells of s and t of the patterns in both, and what each could move from s to t."""
        a, b = self.of[s], self.of[t]
        _, i, j = np.intersect1d(self.pattern[a], self.pattern[b], assume_unique=True, return_indices=True)
        i, j = i + a.start, j + b.start
        return i, j, np.maximum(np.minimum(self.flow[i], self.room[j] - self.flow[j]), 0.0)

    def _reached(self) -> tuple[np.ndarray, np.ndarray]:
        """Steps from the open supplies to each source (-1: none), and the patterns on the way."""
        steps = np.full(len(self.of), -1)
        inside = self.supply > EPS
        spare = self.room - self.flow > EPS
        for k in range(len(self.of) + 1):
            new = np.unique(self.source[spare & inside[self.pattern]])
            new = new[steps[new] < 0]
            if not len(new):
                break
            steps[new] = k
            back = (self.flow > EPS) & (steps[self.source] >= 0)
            inside = inside | (np.bincount(self.pattern[back], minlength=self.n) > 0)
        return steps, inside

    def fill(self) -> np.ndarray:
        """Give as much of the supplies as the quotas take; the patterns that hang on what is left."""
        while True:
            for s in np.flatnonzero(self.left > EPS):
                self._push(s)
            if not (self.supply > EPS).any():
                return np.zeros(self.n, bool)
            steps, inside = self._reached()
            ends = np.flatnonzero((steps >= 0) & (self.left > EPS))
            if not len(ends) or not self._augment(steps, ends[np.argmin(steps[ends])]):
                return inside

    def _augment(self, steps: np.ndarray, end: int) -> bool:
        """Move words along a shortest chain of sources to `end`, so that open supplies get in at its start."""
        chain, hops, most = [end], [], self.left[end]
        while steps[chain[-1]] > 0:
            options = ((s, *self._hop(s, chain[-1])) for s in np.flatnonzero(steps == steps[chain[-1]] - 1))
            s, i, j, amounts = max(options, key=lambda o: o[3].sum())
            chain.append(s)
            hops.append((i, j, amounts))
            most = min(most, amounts.sum())
        cells = self.of[chain[-1]]
        first = np.minimum(self.supply[self.pattern[cells]], self.room[cells] - self.flow[cells])
        most = min(most, np.maximum(first, 0.0).sum())
        if most <= EPS:
            return False
        for k, (i, j, amounts) in enumerate(hops):  # from the end back: each hop makes room for the next
            moved = _filled(amounts, most)
            self.flow[i] -= moved
            self.flow[j] += moved
            self.left[chain[k]] -= moved.sum()
            self.left[chain[k + 1]] += moved.sum()
        self._push(chain[-1], most)
        return True


def _use_for(once: np.ndarray, cap: np.ndarray, total: float) -> float:
    """The use at which patterns, each up to its cap, give `total`."""
    order = np.argsort(cap / once)
    once, cap = once[order], cap[order]
    ends = cap / once
    capped = np.concatenate([[0.0], np.cumsum(cap)])[:-1]
    rising = np.cumsum(once[::-1])[::-1]
    at_end = capped + ends * rising  # given when the k-th pattern comes to its cap
    k = int(np.searchsorted(at_end, total))
    return float(ends[-1]) if k == len(once) else (total - capped[k]) / rising[k]


def even_flow(pattern: np.ndarray, source: np.ndarray, room: np.ndarray, once: np.ndarray, quota: np.ndarray) -> np.ndarray:
    """Words each cell gives: quotas are filled as far as they can be, and patterns used as evenly.

    `room` bounds a cell, `once` are a pattern's words (used once), `quota` a source's.
    """
    order = np.lexsort((pattern, source))
    pattern, source, room = pattern[order], source[order], room[order].astype(float)
    flow = _Flow(pattern, source, room, quota, len(once))
    cap = np.bincount(pattern, room, len(once))
    active = (cap > EPS) & (once > 0)
    once = np.maximum(once.astype(float), 1.0)
    fixed = flow.state()
    while active.any():
        use, tight = float((cap[active] / once[active]).max()), None
        while True:
            flow.restore(fixed)
            wanted = np.where(active, np.minimum(use * once, cap), 0.0)
            flow.supply = np.where(active, np.maximum(wanted - flow.given(), 0.0), 0.0)
            hung = flow.fill() & active
            if not hung.any():
                break
            tight = hung
            lower = _use_for(once[hung], cap[hung], float(flow.given()[hung].sum()))
            if lower >= use * (1 - 1e-9):
                break
            use = lower
        fixed = flow.state()
        if tight is None:  # all have given what they can
            break
        active &= ~tight & (cap - flow.given() > EPS)
    out = np.empty(len(pattern))
    out[order] = flow.flow
    return out
