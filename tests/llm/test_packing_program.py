"""The configuration program: bounds, rounding and the best of both plans."""

from __future__ import annotations

from functools import cache

import numpy as np
import pytest

from candleframe.llm import packing


def histogram(lengths, times, capacity=packing.CAPACITY):
    counts = np.zeros(capacity + 1, dtype=np.int64)
    np.add.at(counts, np.asarray(lengths), times)
    return counts


def check(counts, capacity, plan):
    used = np.zeros(capacity + 1, dtype=np.int64)
    for pattern, m in plan:
        assert m > 0 and sum(k * n for k, n in pattern.items()) <= capacity
        for k, n in pattern.items():
            used[k] += m * n
    assert (used == counts).all()


RNG = np.random.default_rng(0)
CASES = {
    "seven": histogram([700, 1000, 1366, 1367, 1400, 2049, 2731], 10_000),
    "uneven": histogram([700, 1000, 1366, 1367, 1400, 2049, 2731], RNG.integers(1_000, 20_000, 7)),
    "thirds": histogram([1366, 1365, 2000, 2096, 900], [5000, 3000, 7000, 100, 2222]),
    "five": histogram([1025, 821, 1640, 2050, 600], [999, 12_345, 5000, 7777, 333]),
    "few": histogram([1500, 1300, 1100, 900], [7, 5, 9, 3]),
    "halves": histogram([2048, 2049, 2047, 1], [100, 100, 100, 50]),
    "middle": np.bincount(RNG.integers(1200, 1701, 9_000), minlength=4097),
    "wide": np.bincount(RNG.integers(1, 4097, 4_000), minlength=4097),
    "texts": np.bincount(np.clip(RNG.lognormal(6.5, 1.1, 8_000).astype(int), 1, 4096), minlength=4097),
    "full": histogram([4096, 1], [30, 5]),
}


@pytest.mark.parametrize("name", CASES)
def test_never_worse_than_best_fit(name):
    counts = CASES[name]
    plain = packing.best_fit(counts, 4096)
    plan, bound = packing.configurations(counts, 4096, rounds=100)
    check(counts, 4096, plain)
    check(counts, 4096, plan)
    assert bound <= packing.size_of(plan) <= packing.size_of(plain)
    assert bound >= -(-int((counts * np.arange(4097)).sum()) // 4096)


def test_the_program_beats_best_fit():
    plan, bound = packing.configurations(CASES["thirds"], 4096)
    assert packing.size_of(plan) < packing.size_of(packing.best_fit(CASES["thirds"], 4096))
    assert packing.size_of(plan) <= 1.001 * bound
    assert packing.size_of(packing.configurations(CASES["middle"], 4096, rounds=100)[0]) < packing.size_of(packing.best_fit(CASES["middle"], 4096))


def optimum(counts, capacity):
    """Fewest bins, by search over all states of what is left."""
    lengths = [k for k in range(1, capacity + 1) if counts[k]]

    def patterns(left, i, room):
        if i < 0:
            yield ()
            return
        for n in range(min(left[i], room // lengths[i]) + 1):
            for rest in patterns(left, i - 1, room - n * lengths[i]):
                yield (*rest, n)

    @cache
    def best(left):
        if not any(left):
            return 0
        top = max(i for i, n in enumerate(left) if n)  # some bin holds the longest item
        return 1 + min(best(tuple(a - b for a, b in zip(left, p, strict=True))) for p in patterns(left, len(left) - 1, capacity) if p[top])

    return best(tuple(int(counts[k]) for k in lengths))


def test_small_instances_against_the_optimum():
    rng = np.random.default_rng(4)
    over = 0
    for _ in range(40):
        capacity = int(rng.integers(10, 21))
        lengths = rng.choice(np.arange(2, capacity + 1), 4, replace=False)
        counts = histogram(lengths, rng.integers(1, 5, 4), capacity)
        plan, bound = packing.configurations(counts, capacity)
        check(counts, capacity, plan)
        least = optimum(counts, capacity)
        assert bound <= least <= packing.size_of(plan)
        over += packing.size_of(plan) - least
    assert over <= 1


def test_prices_are_the_best_multiset():
    rng = np.random.default_rng(2)
    for _ in range(20):
        capacity = int(rng.integers(5, 30))
        weights = np.full(capacity + 1, -np.inf)
        some = rng.choice(np.arange(1, capacity + 1), 3, replace=False)
        weights[some] = rng.random(3)
        take = packing.price(weights, capacity)
        best = np.zeros(capacity + 1)
        for c in range(1, capacity + 1):
            best[c] = max([best[c - 1], *(best[c - k] + weights[k] for k in some.tolist() if k <= c)])
        assert float(take[some] @ weights[some]) == pytest.approx(best[capacity])
        assert (take * np.arange(capacity + 1)).sum() <= capacity
