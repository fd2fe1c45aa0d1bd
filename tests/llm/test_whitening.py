"""Whitening and its eigensolver against a dense solver and exact arithmetic."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from candleframe.llm import feast
from candleframe.llm.queries import QUERIES
from candleframe.llm.whitening import fit_whitening, whiten

SF = "/root/testdata/sf0.01"
NAN, INF = float("nan"), float("inf")


def integers(vectors):
    return np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000


def exact_deviations(x):
    n, sums = len(x), x.sum(axis=0).astype(object)
    return [int(((n * row.astype(object) - sums) ** 2).sum()) for row in x]


def dense(x):
    centred = x - x.mean(axis=0)
    return centred, np.linalg.eigh(centred.T @ centred / len(x))


def test_op13(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = integers([v for _, v in rows])
    centred, (values, vectors) = dense(x)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    want = centred @ vectors / np.sqrt(values)
    got = QUERIES["op13_embedding_whitening"](spark, SF).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in got] == [(i, k) for i, _ in rows for k in range(1, 33)]
    w = np.array([r.whitened for r in got]).reshape(len(rows), 32)
    assert np.abs(w * np.sign((w * want).sum(axis=0)) - want).max() < 1e-9
    assert [r.deviation for r in got[::32]] == exact_deviations(x) and {r.n for r in got} == {len(rows)}
    trace = centred.var(axis=0).sum()
    assert np.allclose([r.explained for r in got[:32]], values / trace, rtol=1e-12)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    bad = [(100, None), (101, [NAN] * 5), (102, [1.0, 2.0, INF, 0.0, 0.0]), (103, [1.0, None, 0.0, 0.0, 0.0]), (104, []),
           (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0, 0.0])]
    same = [(7, good[7][1]), (7, good[7][1]), (None, good[8][1])]
    df = spark.createDataFrame([(i, v, i, "x") for i, v in good + bad + same], "vec_id long, embedding array<double>, _v long, Whitened string")
    fit = fit_whitening(df)
    out = whiten(df, fit)
    assert out.columns == ["vec_id", "embedding", "_v", "whitened", "deviation"]
    got = out.collect()
    x = integers([v for _, v in good + same])
    assert fit.n == 43 and len(fit.values) == 5 and fit.identity_error < 1e-12
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in good + same)
    assert sorted(r.deviation for r in got) == sorted(exact_deviations(x))
    w = np.array([r.whitened for r in got])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(5)).max() < 1e-12


def test_no_vectors_and_no_variance(spark):
    ddl = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], ddl)
    assert fit_whitening(none) is None and whiten(none, None).collect() == []
    flat = spark.createDataFrame([(i, [1.0, -2.0]) for i in range(9)], ddl)
    fit = fit_whitening(flat)
    assert fit.n == 9 and len(fit.values) == 0
    assert [(list(r.whitened), r.deviation) for r in whiten(flat, fit).collect()] == [([], 0)] * 9
    # Fewer vectors than dimensions: no more components than directions with variance.
    few = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0]), (2, [0.0, 0.0, 1.0, 0.0])], ddl)
    fit = fit_whitening(few)
    assert len(fit.values) == 2 and fit.identity_error < 1e-12


def test_partitions_do_not_matter(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, (1e6 * rng.standard_normal(6)).tolist()) for i in range(500)], "vec_id long, embedding array<double>")
    a, b = fit_whitening(df.repartition(1)), fit_whitening(df.repartition(17).orderBy(F.desc("vec_id")))
    assert (a.values == b.values).all() and (a.vectors == b.vectors).all() and a.sums == b.sums


def test_deviation_beyond_a_long(spark):
    df = spark.createDataFrame([(0, [1e13]), (1, [-1e13]), (2, [0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whiten(df, fit_whitening(df)).collect()}
    assert got[0].deviation is None and got[1].deviation is None and got[2].deviation == 0
    assert abs(got[0].whitened[0]) == pytest.approx(1.5**0.5)


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 64), np.full(64, 2.0), np.r_[np.full(5, 3.0), np.zeros(40)], np.r_[1.0, np.linspace(1e-4, 2e-4, 30)],
    np.repeat([3.0, 1.0, 0.5], 20), 10.0 ** -np.linspace(0, 9, 40), np.linspace(1, 1 + 1e-9, 40), [2.0],
    np.r_[1, 1e4 * feast.EPS * 64 * np.exp2(np.linspace(-2, 2, 63))],
], ids=["even", "equal", "rank", "spike", "clusters", "falling", "tight", "one", "floor"])
def test_feast_finds_all(values):
    values = np.asarray(values, dtype=float)
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    a /= np.abs(a).sum(axis=1).max()
    form = feast.tridiagonal(a)
    exact = np.linalg.eigvalsh(a)
    shifts = (exact[1:] + exact[:-1])[np.diff(exact) > 1e-12] / 2
    assert feast.count_below(form, shifts).tolist() == [(exact < s).sum() for s in shifts]
    bound = feast.floor_near(form, 1e4 * feast.EPS * d)
    cut = feast.intervals(form, bound, 1.001)
    assert sum(n for _, _, n in cut) == (exact > bound).sum()
    found, vectors = feast.joined(a, np.concatenate([feast.inside(a, *c)[1] for c in cut], axis=1))
    assert np.abs(found - exact[::-1][: len(found)]).max() < 1e-14
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-13


def test_feast_says_what_it_misses():
    with pytest.raises(ArithmeticError):
        feast.inside(np.diag([0.1, 0.2, 0.9]), 0.05, 0.5, 3)
