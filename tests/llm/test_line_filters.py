"""Line dedup's filters, and that only suspected repeats leave the task that reads them."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candleframe.llm import line_dedup as module
from candleframe.llm.line_dedup import Bloom, line_dedup


def test_filters_grow_and_miss_nothing():
    rng = np.random.default_rng(1)
    held = np.unique(rng.integers(-(2**63), 2**63 - 1, 60_000))
    bloom = Bloom()
    for part in np.array_split(held, 7):
        bloom.add(part)
    assert len(bloom.layers) > 2 and sum(map(len, bloom.layers)) < 40 * len(held)
    other = rng.integers(-(2**63), 2**63 - 1, 50_000)
    for b in (bloom, Bloom(bloom.pack())):
        assert b.seen(held).all()
        assert b.seen(other).mean() < 0.06
        assert (b.seen(other) == bloom.seen(other)).all()
    assert not Bloom(b"").seen(held).any() and not Bloom().seen(held[:0]).any()


LINES = [f"a line that many documents share, number {k}" for k in range(5)]
ROWS = [(i, "\n".join([f"an own line of document number {i}", LINES[i % 5], f"line of two documents, {i // 2}"])) for i in range(3_000)]


def brute(rows):
    keys = [(i, [x.strip(" \t\n\x0b\x0c\r").lower() for x in t.split("\n")]) for i, t in rows]
    holders = {}
    for i, ks in keys:
        for k in set(ks):
            holders.setdefault(k, set()).add(i)
    bad = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    return Counter((i, "\n".join(x for x, k in zip(t.split("\n"), ks, strict=True) if bad.get(k, i) == i)) for (i, t), (_, ks) in zip(rows, keys, strict=True))


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_BYTES": -1}, {"HOT_DOCS": 100}])
def test_all_ways_give_the_same(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(module, name, value)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(8)
    got = line_dedup(df)
    assert Counter((r.doc_id, r.text) for r in got.collect()) == brute(ROWS)


def test_only_suspects_are_written(spark, monkeypatch):
    """Of 9,000 lines 6,000 repeat: about as many rows, not all, go on."""
    written = {}
    whole = module.stage

    def seen(df, name):
        out = whole(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(module, "stage", seen)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(8)
    line_dedup(df).collect()
    assert 6_000 <= written["suspects"] < 6_300
    plan = line_dedup(df)  # and the lines are not shuffled to find them
    assert plan.where(F.col("n_dropped") > 0).count() == 3_000 - 5
