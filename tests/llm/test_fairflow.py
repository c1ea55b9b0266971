"""The even-use flow against unit-by-unit least-cost flow, and at many patterns and uses."""

import time
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import mixing
from siltstone.llm.fairflow import even_flow


def unit_flow(pattern, source, room, once, quota):
    """Least sum of squared uses by shortest augmenting paths of one word each, cheapest pattern first."""
    flow, left, used = np.zeros(len(pattern), int), quota.copy(), np.zeros(len(once), int)
    while True:
        for p in np.lexsort((np.arange(len(once)), (2 * used + 1) / once)):
            came, queue, end = {("p", p): None}, deque([("p", p)]), None
            while queue and end is None:
                kind, at = queue.popleft()
                for k in range(len(pattern)):
                    if kind == "p" and pattern[k] == at and flow[k] < room[k] and ("s", source[k]) not in came:
                        came["s", source[k]] = (k, 1, (kind, at))
                        if left[source[k]] > 0:
                            end = ("s", source[k])
                            break
                        queue.append(("s", source[k]))
                    if kind == "s" and source[k] == at and flow[k] > 0 and ("p", pattern[k]) not in came:
                        came["p", pattern[k]] = (k, -1, (kind, at))
                        queue.append(("p", pattern[k]))
            if end is not None:
                break
        else:
            return np.bincount(pattern, flow, len(once))
        left[end[1]] -= 1
        used[p] += 1
        while came[end] is not None:
            k, sign, end = came[end]
            flow[k] += sign


@pytest.mark.parametrize("seed", range(40))
def test_against_unit_flow(seed):
    rng = np.random.default_rng(seed)
    n_p, n_s = int(rng.integers(1, 6)), int(rng.integers(1, 5))
    cells = [(p, s) for p in range(n_p) for s in range(n_s) if rng.random() < 0.6] or [(0, 0)]
    pattern, source = (np.array(x) for x in zip(*cells))
    once = 10 * rng.integers(1, 5, n_p)
    room, quota = 10 * rng.integers(1, 12, len(cells)), 10 * rng.integers(0, 15, n_s)
    got = even_flow(pattern, source, room, once, quota)
    assert (got >= -1e-6).all() and (got <= room + 1e-6).all()
    assert (np.bincount(source, got, n_s) <= quota + 1e-6).all()
    mine, best = np.bincount(pattern, got, n_p), unit_flow(pattern, source, room, once, quota)
    assert abs(mine.sum() - best.sum()) <= 1.0 + n_p
    cost = [float((once * np.square(x / once)).sum()) for x in (mine, best)]
    assert cost[0] <= cost[1] + 0.02 * cost[1] + 1.0 and np.abs(mine - best).max() <= 2.0


def test_uses_have_no_limit():
    """Two equal patterns whose texts stand in a hundred rows each: both are used as often."""
    cells = {("a", "s"): 10_000, ("b", "s"): 10_000}
    for quota in (100, 150, 200, 20_000, 50_000):
        flow = mixing.route(cells, {"s": quota}, 3, {"a": 100, "b": 100})
        assert abs(flow["a", "s"] - quota / 2) < 1 and abs(flow["b", "s"] - quota / 2) < 1


def test_a_hundred_thousand_patterns():
    """All use the same share, as all sources are large enough for it; in time and memory for the driver."""
    rng = np.random.default_rng(1)
    sets = np.unique(rng.integers(1, 1 << 20, 130_000))[:100_000]
    pattern, source = np.nonzero((sets[:, None] >> np.arange(20)) & 1)
    once = rng.integers(1, 1000, len(sets)).astype(float)
    room = 3.0 * once[pattern]
    began = time.time()
    quota = np.full(20, once.sum() * 1.5 / 20)
    flow = even_flow(pattern, source, room, once, quota)
    use = np.bincount(pattern, flow, len(sets)) / once
    assert np.abs(np.bincount(source, flow, 20) - quota).max() < 1 + len(sets) * 1e-6
    small = once < 20  # half a word is much of a small pattern
    assert np.abs(use[~small] - 1.5).max() < 0.05 and time.time() - began < 60


def test_mixing_many_source_sets(spark):
    """Every text in a set of sources of its own; the least-cost uses follow from the words alone."""
    rows = [(i, " ".join(["w"] * 10 + [f"t{i}"]), f"s{s:02d}") for i in range(400) for s in range(12) if (i * 2654435761 >> s) & 1]
    docs = spark.createDataFrame([(n, t, s) for n, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    got = mixing.mix_documents(docs)
    by = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.05 * r["target"] for r in by) and got.where("copies > 3 or copies < 0").isEmpty()
