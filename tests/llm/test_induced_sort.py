"""External induced sorting against plain sorting, with queues that spill."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candleframe.llm import induced_sort as ind


@pytest.fixture(autouse=True)
def tiny_queues(monkeypatch):
    monkeypatch.setattr(ind, "CHUNK", 3)
    monkeypatch.setattr(ind, "IN_MEMORY", 4)


texts = st.lists(st.integers(1, 3), min_size=1, max_size=60).flatmap(
    lambda t: st.sampled_from([t, t + t, t + t[: len(t) // 2] + t, [1] * 20 + t])
)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_order_and_common_prefixes(t):
    t = np.array(t, dtype=np.uint8)
    n = len(t)
    got = np.concatenate(list(ind.suffix_order(t, 10_000)))
    got = got[got["pos"] < n]
    want = sorted(range(n), key=lambda i: t[i:].tolist(), reverse=True)
    assert got["pos"].tolist() == want
    for a, b, lcp in zip(want[:-1], want[1:], got["lcp"][1:].tolist(), strict=True):
        x, y = t[a:].tolist(), t[b:].tolist()
        same = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert lcp == same


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 8), st.integers(0, 2**32))
def test_repeated_windows(t, depth, seed):
    t = np.array(t, dtype=np.uint8)
    n = len(t)
    wanted = np.random.default_rng(seed).random(n) < 0.7
    wanted[max(0, n - depth + 1) :] = False
    count = Counter(tuple(t[i : i + depth].tolist()) for i in range(n) if wanted[i])
    want = [bool(wanted[i]) and count[tuple(t[i : i + depth].tolist())] > 1 for i in range(n)]
    assert ind.repeated(t, wanted, depth).tolist() == want
