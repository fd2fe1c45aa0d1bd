"""Rows are told apart by their number: NULL ids, tied ids and texts of equal checksums; column names of any case."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candleframe.llm import jaccard_join
from candleframe.llm.quality import quality_rules
from candleframe.llm.suffix_dedup import suffix_dedup, valid_text
from candleframe.llm.topk import top_k
from candleframe.llm.url_filter import url_filter

PASSAGE = "a passage that two texts share, long enough to be cut from either of them: " * 3


def words(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


@pytest.fixture(scope="module")
def clash():
    """(text with the passage, unrelated text) of one crc32."""
    rng = random.Random(11)
    base, other = words(rng, 40), words(rng, 40)
    seen = {}
    for _ in range(200_000):
        first, t = f"{PASSAGE}{base} {words(rng, 2)}", f"{other} {words(rng, 2)}"
        seen[zlib.crc32(first.encode())] = first
        if zlib.crc32(t.encode()) in seen:
            a = seen[zlib.crc32(t.encode())]
            assert zlib.crc32(a.encode()) == zlib.crc32(t.encode())
            return a, t
    raise AssertionError("no pair of one checksum")


@pytest.mark.parametrize("ids", [(None, None, None), (5, 5, 5), (1, 2, 3)])
def test_suffix_dedup(spark, clash, ids):
    a, unrelated = clash
    rows = list(zip(ids, [a, unrelated, PASSAGE + "an end of its own"], strict=True))
    want = None
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        got = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup(df).collect())
        want = want or got
        assert got == want
    assert got[ids[1], len(unrelated), 0] == 1  # nothing is cut from the unrelated text
    assert sorted(n for _, _, n in got.elements()) == [0, len(PASSAGE), len(PASSAGE)]


@pytest.mark.parametrize("ids", [(5, 5, 9), (None, None, 9), (1, 2, 9)])
def test_jaccard_components(spark, ids):
    rng = random.Random(3)
    base, other = words(rng, 200), words(rng, 200)
    seen, pair = {}, None
    for _ in range(300_000):
        first, t = f"{base} {words(rng, 2)}", f"{other} {words(rng, 2)}"
        seen[zlib.crc32(first.encode())] = first
        pair = (seen.get(zlib.crc32(t.encode())), t)
        if pair[0]:
            break
    rows = list(zip(ids, [*pair, f"{base} end"], strict=True))
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        rows_of, links = jaccard_join.jaccard_links(df)
        assert links.distinct().count() == 1
        got = Counter((r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(df).collect())
        least = min((i for i in (ids[0], 9) if i is not None))
        assert got == Counter([(ids[0], least), (9, least), (ids[1], ids[1])])


def test_top_k_of_large_weights(spark):
    """Bounds beyond 64 bits: exact scores where they fit a long, else an error, never a wrapped one."""
    big = float(2**40) / 64
    df = spark.createDataFrame([(0, [big, 1 / 64]), (1, [0.0, big]), (2, [1 / 64, 0.0]), (3, [0.0, -big])], "vec_id long, embedding array<double>")
    got = top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**40), (2, 2**40), (3, -(2**40))]
    with pytest.raises(Exception, match="too large"):
        top_k(df.union(spark.createDataFrame([(4, [big, 0.0])], df.schema)), F.col("vec_id") == 0).collect()


def test_quality_columns_of_any_case(spark):
    df = spark.createDataFrame([(1, "a b c", "h", 7, 8, 9, "x")], "doc_id long, text string, source string, N_words int, _host int, _q_x int, KEPT string")
    out = quality_rules(df)
    (r,) = out.collect()
    assert r.n_words == 3 and r._host == 8 and r._q_x == 9 and r.kept is False
    assert len({c.lower() for c in out.columns}) == len(out.columns)


def test_url_columns_of_any_case(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", 7, "h", "v")], "page_id long, url string, _hit int, HOST string, Verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = url_filter(pages, labels)
    (r,) = out.collect()
    assert r._hit == 7 and r.host == "a.org" and r.verdict == "allow"
    assert len({c.lower() for c in out.columns}) == len(out.columns)


def test_suffix_columns_of_any_case(spark, tmp_path):
    df = spark.createDataFrame([(1, PASSAGE, 3, "k", 5), (2, PASSAGE, 4, "l", 6)], "doc_id long, text string, N_BYTES int, KEPT string, _k int")
    out = suffix_dedup(df)
    assert sorted(c.lower() for c in out.columns) == ["_k", "doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    out.write.parquet(str(tmp_path / "o"))
    assert {(r.doc_id, r._k, r.text) for r in valid_text(out).collect()} == {(1, 5, ""), (2, 6, "")}


def test_sketches_bound_the_difference():
    """Counts of two sets differ by no more than the sets do, also between sketches of different width."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 3_000))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, max(1, n // 3)):], rng.integers(0, 2**63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)]))
        x, y = (np.frombuffer(jaccard_join.sketches(s, np.array([len(s)]))[0], np.uint8)[None] for s in (a, b))
        w = min(x.shape[1], y.shape[1])
        apart = np.abs(jaccard_join.folded(x, w).astype(int) - jaccard_join.folded(y, w).astype(int)).sum()
        assert apart <= len(np.setxor1d(a, b))
