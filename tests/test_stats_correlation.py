"""Correlation matrices, hour/return correlation, Spearman and the t-test p-value."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candleframe.functions.stats import student_t_two_sided_p
from candleframe.operators import activity, correlation, rank_stats

RET_DDL = "base_currency string, quote_currency string, year bigint, open_time timestamp_ntz, `return` double"


def _returns(spark, rows):
    return spark.createDataFrame(
        [(b, q, t.year, t, r) for b, q, t, r in rows], RET_DDL
    )


def _t(day, hour=0, minute=0, year=2021):
    return dt.datetime(year, 1, day, hour, minute)


def _pandas_matrix(rows, base, year, keys):
    """The pivot-then-correlate computation on the driver, as a brute-force reference."""
    pdf = pd.DataFrame(rows, columns=["base", "quote", "open_time", "ret"])
    pdf["year"] = pdf.open_time.dt.year
    sub = pdf[(pdf.base == base) & (pdf.year == year) & (pdf.open_time.dt.minute == 0)]
    wide = sub.pivot_table(index="open_time", columns="quote", values="ret").reindex(columns=keys)
    return wide.corr()


PARTIAL = [
    # A at 4 times, B shares 2 of them plus 1 own; C only in 2021; a duplicate cell for A.
    ("BTC", "A", _t(1), 0.10), ("BTC", "A", _t(2), -0.20), ("BTC", "A", _t(3), 0.05), ("BTC", "A", _t(4), 0.30),
    ("BTC", "A", _t(4), 0.10),
    ("BTC", "B", _t(1), 0.20), ("BTC", "B", _t(3), 0.01), ("BTC", "B", _t(5), 0.40),
    ("BTC", "C", _t(1), 0.50), ("BTC", "C", _t(2), 0.10), ("BTC", "C", _t(3), 0.20), ("BTC", "C", _t(4), 0.90),
    ("BTC", "A", _t(1, year=2022), 0.1), ("BTC", "A", _t(2, year=2022), 0.2), ("BTC", "A", _t(3, year=2022), 0.4),
    ("BTC", "B", _t(1, year=2022), 0.3), ("BTC", "B", _t(2, year=2022), 0.1), ("BTC", "B", _t(3, year=2022), 0.2),
    ("BTC", "A", _t(1, minute=30), 9.0),  # not at minute 0: ignored
]


def test_partial_overlap_dense_grid_matches_pandas(spark):
    keys = ["A", "B", "C"]
    out = correlation.corr_across_quotes(
        _returns(spark, PARTIAL), quotes=keys, bases=["BTC"], years=[2020, 2021, 2022]
    ).collect()
    assert len(out) == 3 * 9
    got = {(r.year, r.quote_a, r.quote_b): (r.corr, r.n_obs) for r in out}
    for year in (2021, 2022):
        ref = _pandas_matrix(PARTIAL, "BTC", year, keys)
        for a in keys:
            for b in keys:
                c, n = got[(year, a, b)]
                if pd.isna(ref.loc[a, b]):
                    assert c is None
                else:
                    assert c == pytest.approx(ref.loc[a, b], abs=1e-12)
    # Empty year: every cell present, n_obs 0, corr NULL. Absent quote C in 2022 likewise.
    assert all(got[(2020, a, b)] == (None, 0) for a in keys for b in keys)
    assert got[(2022, "A", "C")] == (None, 0) and got[(2022, "C", "C")] == (None, 0)
    # Pairwise-complete counts and symmetry.
    assert got[(2021, "A", "B")][1] == 2 and got[(2021, "A", "C")][1] == 4
    assert all(got[(y, a, b)] == got[(y, b, a)] for y in (2021, 2022) for a in keys for b in keys)


def test_duplicate_cell_is_averaged(spark):
    rows = [
        ("BTC", "A", _t(1), 1.0), ("BTC", "A", _t(1), 3.0), ("BTC", "A", _t(2), 0.0), ("BTC", "A", _t(3), 5.0),
        ("BTC", "B", _t(1), 1.0), ("BTC", "B", _t(2), 2.0), ("BTC", "B", _t(3), 2.0),
    ]
    out = correlation.corr_across_quotes(_returns(spark, rows), quotes=["A", "B"], bases=["BTC"], years=[2021])
    c = out.where("quote_a = 'A' AND quote_b = 'B'").first().corr
    assert c == pytest.approx(np.corrcoef([2.0, 0.0, 5.0], [1.0, 2.0, 2.0])[0, 1], abs=1e-12)


def test_constant_series_gives_null_correlation(spark):
    rows = [("BTC", "A", _t(d), 0.5) for d in range(1, 5)] + [("BTC", "B", _t(d), 0.1 * d) for d in range(1, 5)]
    out = correlation.corr_across_quotes(_returns(spark, rows), quotes=["A", "B"], bases=["BTC"], years=[2021])
    got = {(r.quote_a, r.quote_b): r.corr for r in out.collect()}
    assert got[("A", "B")] is None and got[("A", "A")] is None
    assert got[("B", "B")] == pytest.approx(1.0)


def test_corr_across_bases_swaps_roles(spark):
    rows = [(b, "USDT", _t(d), v) for b, s in (("ADA", 1.0), ("ETH", -1.0)) for d, v in ((1, s), (2, 2 * s), (3, 0.5 * s))]
    out = correlation.corr_across_bases(_returns(spark, rows), quotes=["USDT"], bases=["ADA", "ETH"], years=[2021])
    got = {(r.base_a, r.base_b): (r.corr, r.n_obs) for r in out.collect()}
    assert got[("ADA", "ETH")][0] == pytest.approx(-1.0) and got[("ADA", "ETH")][1] == 3
    assert set(out.columns) == {"quote_currency", "year", "base_a", "base_b", "corr", "n_obs"}


def _hour_returns(spark, rows):
    return spark.createDataFrame(
        [(b, q, dt.datetime(2021, 1, 1, h, m), r) for b, q, h, m, r in rows],
        "base_currency string, quote_currency string, open_time timestamp_ntz, `return` double",
    )


def test_hour_return_correlation_matches_indicator_correlation(spark):
    rng = np.random.default_rng(7)
    rows = [("BTC", "USDT", int(h), int(m), float(r)) for h, m, r in zip(rng.integers(0, 24, 300), rng.integers(0, 60, 300), rng.normal(0, 0.01, 300))]
    out = {r.hour_of_day: r for r in correlation.hour_return_correlation(_hour_returns(spark, rows)).collect()}
    hours = np.array([r[2] for r in rows])
    y = np.array([r[4] for r in rows])
    for h, r in out.items():
        x = (hours == h).astype(float)
        ref = np.corrcoef(x, y)[0, 1]
        assert r.corr == pytest.approx(ref, abs=1e-9)
        assert r.corr_clipped == pytest.approx(max(-0.5, min(0.5, ref)), abs=1e-9)


def test_one_hour_pair_gives_null(spark):
    rows = [("ETH", "EUR", 5, m, 0.01 * m) for m in range(10)]
    out = correlation.hour_return_correlation(_hour_returns(spark, rows)).collect()
    assert len(out) == 1 and out[0].corr is None and out[0].corr_clipped is None


def test_missing_hours_are_null_columns(spark):
    df = spark.createDataFrame(
        [("BTC", "USDT", dt.datetime(2021, 1, 1, h, 0), v) for h, v in ((0, 1.0), (0, 3.0), (23, 9.0))],
        "base_currency string, quote_currency string, open_time timestamp_ntz, volume double",
    )
    m = activity.hourly_volume_matrix(df)
    assert m.columns == ["pair"] + [f"h{h:02d}" for h in range(24)]
    r = m.first()
    assert r.pair == "BTC-USDT"
    assert r.h00 == pytest.approx(math.log1p(2.0)) and r.h23 == pytest.approx(math.log1p(9.0))
    assert all(r[f"h{h:02d}"] is None for h in range(1, 23))


def test_tied_ranks_are_averaged(spark):
    df = spark.createDataFrame(
        [("A", "Q", v, r) for v, r in ((1.0, 0.1), (2.0, 0.3), (2.0, 0.2), (3.0, 0.4))],
        "base_currency string, quote_currency string, volume double, `return` double",
    )
    out = rank_stats.spearman(df).first()
    rx, ry = [1, 2.5, 2.5, 4], [1, 3, 2, 4]
    assert out.n == 4 and out.rho == pytest.approx(np.corrcoef(rx, ry)[0, 1], abs=1e-12)


def test_spearman_drops_nulls_and_handles_constants(spark):
    df = spark.createDataFrame(
        [("A", "Q", 1.0, 0.1), ("A", "Q", None, 0.3), ("A", "Q", 2.0, None), ("A", "Q", 3.0, 0.5),
         ("B", "Q", 5.0, 0.1), ("B", "Q", 5.0, 0.2), ("B", "Q", 5.0, 0.3)],
        "base_currency string, quote_currency string, volume double, `return` double",
    )
    df = df.unionByName(spark.createDataFrame([("C", "Q", None, 0.1), ("C", "Q", 4.0, None)], df.schema))
    got = {r.base_currency: r for r in rank_stats.spearman(df).collect()}
    assert got["A"].n == 2 and got["A"].rho == pytest.approx(1.0) and got["A"].p_value is None
    assert got["B"].n == 3 and got["B"].rho is None and got["B"].p_value is None
    # A group without a complete row is kept: n = 0, no statistics.
    assert got["C"].n == 0 and got["C"].rho is None and got["C"].p_value is None


# (r, n, two-sided p) checked against numerical integration of the Student-t density.
P_CASES = [
    (0.5, 3, 0.666667), (0.5, 4, 0.5), (0.5, 5, 0.391002), (0.5, 6, 0.3125), (0.5, 7, 0.253170),
    (0.5, 10, 0.141113), (0.1, 9, 0.797972), (-0.3, 103, 0.00207870), (0.05, 2000, 0.0253473),
]


def test_student_t_p_value(spark):
    df = spark.createDataFrame([(r, n) for r, n, _ in P_CASES], "r double, n bigint")
    got = [row.p for row in df.select(student_t_two_sided_p("r", "n").alias("p")).collect()]
    for (r, n, p), g in zip(P_CASES, got):
        assert g == pytest.approx(p, rel=1e-5, abs=1e-9), (r, n)


def test_p_value_tails_keep_their_relative_accuracy(spark):
    """Against the finite series for odd and even degrees of freedom in exact rational arithmetic."""
    from fractions import Fraction

    def exact(r, n):  # n even: v even; p = 1 - sin(theta) * sum of central binomials * cos^2k
        v = n - 2
        s = Fraction(r).limit_denominator(10**6)
        c2 = 1 - s * s
        total, term = Fraction(0), Fraction(1)
        for k in range(v // 2):
            total += term
            term = term * c2 * (2 * k + 1) / (2 * k + 2)
        return float(1 - abs(s) * total)

    cases = [(0.3, 200), (0.5, 400), (-0.9, 60), (0.9, 120), (0.99, 40), (0.6, 500), (0.05, 30), (0.2, 1000), (0.95, 194)]
    df = spark.createDataFrame(cases, "r double, n bigint")
    got = [row.p for row in df.select(student_t_two_sided_p("r", "n").alias("p")).collect()]
    want = [exact(r, n) for r, n in cases]
    assert min(want) < 1e-90
    for g, w, c in zip(got, want, cases):
        assert g == pytest.approx(w, rel=1e-7), c


def test_p_value_edges(spark):
    df = spark.createDataFrame([(1.0, 10), (-1.0, 5), (0.3, 2), (None, 10), (0.0, 3)], "r double, n bigint")
    got = [row.p for row in df.select(student_t_two_sided_p("r", "n").alias("p")).collect()]
    assert got[0] == 0.0 and got[1] == 0.0 and got[2] is None and got[3] is None
    assert got[4] == pytest.approx(1.0)


def test_matrix_in_bounds_and_symmetric_on_fixture(spark):
    from conftest import SF001

    from candleframe.plans.queries import QUERIES

    m = QUERIES["corr_across_quotes"](spark, SF001)
    bad = m.where((F.col("corr") > 1.0000001) | (F.col("corr") < -1.0000001)).count()
    assert bad == 0
    a = m.alias("a")
    b = m.alias("b")
    j = a.join(
        b,
        (F.col("a.base_currency") == F.col("b.base_currency"))
        & (F.col("a.year") == F.col("b.year"))
        & (F.col("a.quote_a") == F.col("b.quote_b"))
        & (F.col("a.quote_b") == F.col("b.quote_a")),
    )
    assert j.where(~F.col("a.corr").eqNullSafe(F.col("b.corr"))).count() == 0


def test_return_correlation_study_guards_and_grids(spark):
    from candleframe.plans import studies
    from candleframe.sources import fixtures as fx

    from conftest import SF001, SF0001

    hourly = fx.candles_hourly(spark, SF001)
    q, b = studies.return_correlation_study(
        hourly, quotes=("U0", "U1", "U2"), bases=("click", "purchase", "view"), years=(2024,)
    )
    assert q.count() == 3 * 9 and b.count() == 3 * 9
    with pytest.raises(ValueError, match="not quoted in each of"):
        studies.return_correlation_study(hourly, quotes=("U0", "U1"), bases=("click", "nosuch"), years=(2024,))
    # The pair catalog fixture at sf0.001 has no base with three quotes: the guard fires.
    from candleframe.operators import universe
    from candleframe.sources import catalog as cat

    pairs = cat.pair_catalog(fx.pair_files(spark, SF0001))
    with pytest.raises(ValueError, match="needs 3 bases"):
        universe.require_bases(universe.complete_bases(pairs, ("Q0", "Q1", "Q2")), ["CHINA"], target_quotes=("Q0", "Q1", "Q2"))


def test_hour_matrix_agrees_with_long_form(spark):
    from conftest import SF001

    from candleframe.plans.queries import QUERIES

    long = {(r.pair, r.hour_of_day): r.corr_clipped for r in QUERIES["hour_return_correlation"](spark, SF001).collect()}
    wide = QUERIES["hour_return_correlation_matrix"](spark, SF001).collect()
    assert len(wide) == len({p for p, _ in long})
    for row in wide:
        for h in range(24):
            assert row[f"h{h:02d}"] == long.get((row.pair, h))


def test_volume_return_grid_keeps_no_data_cells(spark, candles):
    from candleframe.plans import studies

    rows = []
    for b in ("A", "B", "C"):
        for q in ("X", "Y", "Z"):
            if (b, q) == ("B", "Y"):
                continue  # this cell has no data
            rows += [(b, q, f"2021-01-{d:02d} 00:00", d, 10.0 + d * (1 + (d % 3)), float(d % 4)) for d in range(1, 9)]
    grid = studies.volume_return_grid(candles(rows), k=3).collect()
    assert len(grid) == 9
    cell = {(r.base_currency, r.quote_currency): r for r in grid}
    assert cell[("B", "Y")].n == 0 and cell[("B", "Y")].rho is None and cell[("B", "Y")].p_value is None
    assert all(r.n == 7 for k, r in cell.items() if k != ("B", "Y"))


def test_study_grids_equal_direct_grids(spark):
    from candleframe.plans import studies
    from candleframe.operators import series
    from candleframe.sources import fixtures as fx

    from conftest import SF001

    hourly = fx.candles_hourly(spark, SF001)
    kw = dict(quotes=("U0", "U1", "U2"), bases=("click", "purchase", "view"), years=(2023, 2024))
    q, b = studies.return_correlation_study(hourly, **kw)
    returns = series.candle_returns(hourly)
    q2 = correlation.corr_across_quotes(returns, **kw)
    b2 = correlation.corr_across_bases(returns, **kw)
    for x, y in ((q, q2), (b, b2)):
        rx = sorted((tuple(r[:4]) + (None if r.corr is None else round(r.corr, 9), r.n_obs)) for r in x.collect())
        ry = sorted((tuple(r[:4]) + (None if r.corr is None else round(r.corr, 9), r.n_obs)) for r in y.collect())
        assert rx == ry


def test_return_summaries_equal_separate_passes(spark):
    from candleframe.operators import series
    from candleframe.plans import studies
    from candleframe.sources import fixtures as fx

    from conftest import SF001

    hourly = fx.candles_hourly(spark, SF001)
    kw = dict(quotes=("U0", "U1", "U2"), bases=("click", "purchase", "view"))
    summary, moments = studies.return_summaries(hourly, **kw)
    q, b = studies.correlation_grids(summary, years=(2023, 2024), **kw)
    q2, b2 = studies.return_correlation_study(hourly, years=(2023, 2024), **kw)
    rnd = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert rnd(q.collect()) == rnd(q2.collect()) and rnd(b.collect()) == rnd(b2.collect())
    h = correlation.hour_correlation_from_moments(moments)
    h2 = correlation.hour_return_correlation(series.candle_returns(hourly))
    assert rnd(h.collect()) == rnd(h2.collect())


def test_years_none_uses_years_present(spark):
    out = correlation.corr_across_quotes(_returns(spark, PARTIAL), quotes=["A", "B", "C"], bases=["BTC"], years=None)
    assert sorted({r.year for r in out.collect()}) == [2021, 2022]
    assert out.count() == 2 * 9
