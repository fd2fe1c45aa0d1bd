"""Property tests: results do not depend on partitioning or row order; bucketed lag = brute force."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candleframe.operators import series
from candleframe.plans.queries import QUERIES
from conftest import CANDLE_DDL, SF001

KEYS = ["annual_volatility", "candle_returns", "corr_across_quotes", "volume_return_spearman",
        "hour_return_correlation", "closing_price_series"]


def _collect(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("key", KEYS)
def test_shuffle_partitions_do_not_change_results(spark, key):
    base = _collect(QUERIES[key](spark, SF001))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        other = _collect(QUERIES[key](spark, SF001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert base == other


def test_row_order_does_not_change_returns(spark):
    from candleframe.sources import fixtures as fx

    ticks = fx.candles_ticks(spark, SF001)
    a = series.candle_returns(ticks).select("seq", "prev_close")
    b = series.candle_returns(ticks.repartition(5).orderBy(F.rand(3))).select("seq", "prev_close")
    assert _collect(a) == _collect(b)


candle_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.integers(min_value=0, max_value=60 * 24 * 3),  # minute offset within three days
        st.one_of(st.none(), st.floats(min_value=-5, max_value=5, allow_nan=False)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=candle_rows)
def test_sliced_lag_matches_brute_force(spark, rows):
    start = dt.datetime(2021, 3, 1)
    data = [(b, "Q", start + dt.timedelta(minutes=m), i, c, 1.0) for i, (b, m, c) in enumerate(rows)]
    df = spark.createDataFrame(data, CANDLE_DDL)
    got = {r.seq: r.prev_close for r in series.lag_in_pair(df).collect()}
    sliced = {r.seq: r.prev_close for r in series.lag_in_pair(df, slice_rows=3).collect()}
    want = {}
    for base in ("A", "B"):
        seq = sorted((t, s, c) for b, _, t, s, c, _ in data if b == base)
        for k, (_, s, _) in enumerate(seq):
            want[s] = seq[k - 1][2] if k else None
    assert got == want
    assert sliced == want


def test_hot_pair_is_spread_over_tasks(spark):
    """All ticks in ONE pair: the plain lag runs in one task, the sliced lag spreads out."""
    from candleframe.sources import fixtures as fx

    hot = fx.candles_ticks(spark, SF001).withColumn("base_currency", F.lit("HOT")).withColumn("quote_currency", F.lit("Q"))
    n = hot.count()
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")

        def largest_share(df):
            # Use prev_close so the window is not pruned away; the partition id is that of
            # the task computing the window output.
            sizes = (
                df.select("prev_close", F.spark_partition_id().alias("p"))
                .groupBy("p")
                .agg(F.count(F.lit(1)).alias("rows"), F.count("prev_close").alias("with_prev"))
                .collect()
            )
            assert sum(r.with_prev for r in sizes) == n - 1
            return max(r.rows for r in sizes) / n

        plain = series.lag_in_pair(hot, slice_rows=None)
        bucketed = series.lag_in_pair(hot, slice_rows=n // 64)
        assert largest_share(plain) == 1.0
        assert largest_share(bucketed) < 0.25
        a = {r.seq: r.prev_close for r in plain.select("seq", "prev_close").collect()}
        b = {r.seq: r.prev_close for r in bucketed.select("seq", "prev_close").collect()}
        assert a == b
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_burst_is_spread_over_tasks(spark):
    """Ticks of ONE pair within one millisecond, but for one an hour later: cut by density."""
    start = dt.datetime(2021, 3, 1)
    data = [("HOT", "Q", start + dt.timedelta(microseconds=i), i, float(i + 1), 1.0) for i in range(1000)]
    data.append(("HOT", "Q", start + dt.timedelta(minutes=59), 1000, 7.0, 1.0))
    hot = spark.createDataFrame(data, CANDLE_DDL).repartition(4)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        plain = series.lag_in_pair(hot, slice_rows=None)
        sliced = series.lag_in_pair(hot, slice_rows=20)
        sizes = sliced.select("prev_close", F.spark_partition_id().alias("p")).groupBy("p").agg(
            F.count(F.lit(1)).alias("rows"), F.count("prev_close").alias("with_prev")).collect()
        assert sum(r.with_prev for r in sizes) == len(data) - 1
        assert max(r.rows for r in sizes) < 0.25 * len(data)
        a = {r.seq: r.prev_close for r in plain.select("seq", "prev_close").collect()}
        b = {r.seq: r.prev_close for r in sliced.select("seq", "prev_close").collect()}
        assert a == b and sum(v is None for v in a.values()) == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


ranked_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=5).map(float)),
        st.one_of(st.none(), st.integers(min_value=-3, max_value=3).map(float)),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ranked_rows)
def test_spearman_matches_pandas(spark, rows):
    import numpy as np
    import pandas as pd

    from candleframe.operators import rank_stats

    df = spark.createDataFrame([(b, "Q", v, r) for b, v, r in rows], "base_currency string, quote_currency string, volume double, `return` double")
    got = {r.base_currency: (r.n, r.rho) for r in rank_stats.spearman(df).collect()}
    pdf = pd.DataFrame(rows, columns=["b", "v", "r"])
    for b in set(pdf.b):
        sub = pdf[(pdf.b == b)].dropna()
        n, rho = got[b]
        assert n == len(sub)
        rx, ry = sub.v.rank(method="average"), sub.r.rank(method="average")
        if len(sub) < 2 or rx.std(ddof=0) == 0 or ry.std(ddof=0) == 0:
            assert rho is None
        else:
            assert rho == pytest.approx(float(np.corrcoef(rx, ry)[0, 1]), abs=1e-9)


cell_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C"]),
        st.integers(min_value=1, max_value=6),
        st.one_of(st.none(), st.floats(min_value=-1, max_value=1, allow_nan=False).map(lambda x: round(x, 3))),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=cell_rows)
def test_pairwise_correlation_matches_pandas(spark, rows):
    import pandas as pd

    from candleframe.operators import correlation

    data = [("BTC", q, 2021, dt.datetime(2021, 1, d), r) for q, d, r in rows]
    df = spark.createDataFrame(data, "base_currency string, quote_currency string, year bigint, open_time timestamp_ntz, `return` double")
    keys = ["A", "B", "C"]
    got = {(r.quote_a, r.quote_b): (r.corr, r.n_obs) for r in correlation.corr_across_quotes(df, quotes=keys, bases=["BTC"], years=[2021]).collect()}
    pdf = pd.DataFrame([(q, d, r) for q, d, r in rows], columns=["q", "d", "r"])
    wide = pdf.pivot_table(index="d", columns="q", values="r").reindex(columns=keys)
    ref = wide.corr()
    for a in keys:
        for b in keys:
            c, n = got[(a, b)]
            assert n == int((wide[a].notna() & wide[b].notna()).sum())
            if pd.isna(ref.loc[a, b]):
                assert c is None or n < 2
            else:
                assert c == pytest.approx(float(ref.loc[a, b]), abs=1e-7)


@pytest.mark.parametrize("view", ["candles_ticks", "candles_hourly", "candles_daily"])
def test_top_of_hour_returns_equal_full_lag(spark, view):
    from candleframe.sources import fixtures as fx

    c = getattr(fx, view)(spark, SF001)
    cols = ["base_currency", "quote_currency", "open_time", "seq", "close", "prev_close", "return", "year"]
    full = series.top_of_hour(series.candle_returns(c)).select(*cols)
    for limit in (1_000_000, 2):
        cheap = series.top_of_hour_returns(c, slice_rows=limit).select(*cols)
        assert full.exceptAll(cheap).count() == 0 and cheap.exceptAll(full).count() == 0
    got = {(r.base_currency, r.quote_currency) for r in series.pairs_with_returns(c).collect()}
    want = {(r.base_currency, r.quote_currency) for r in series.candle_returns(c).select("base_currency", "quote_currency").distinct().collect()}
    assert got == want


minute_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        st.integers(min_value=0, max_value=4 * 60 - 1).map(lambda m: m if m % 7 else (m // 60) * 60),  # many minute-0
        st.one_of(st.none(), st.floats(min_value=-5, max_value=5, allow_nan=False)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=minute_rows)
def test_top_of_hour_returns_brute_force(spark, rows):
    start = dt.datetime(2021, 3, 1)
    data = [(b, "Q", start + dt.timedelta(minutes=m), i, c, 1.0) for i, (b, m, c) in enumerate(rows)]
    df = spark.createDataFrame(data, CANDLE_DDL)
    got = {r.seq: r.prev_close for r in series.top_of_hour_returns(df, slice_rows=2).collect()}
    want = {}
    for base in ("A", "B"):
        seq = sorted((t, s, c) for b, _, t, s, c, _ in data if b == base)
        for k, (t, s, _) in enumerate(seq):
            prev = seq[k - 1][2] if k else None
            if t.minute == 0 and prev is not None:
                want[s] = prev
    assert got == want


def test_pairs_with_returns_null_closes(spark, candles):
    df = candles(
        [
            ("A", "Q", "2021-01-01 00:00", 1, 1.0, 1.0),   # single candle: no return
            ("B", "Q", "2021-01-01 00:00", 2, None, 1.0),  # the only close before the last is NULL
            ("B", "Q", "2021-01-01 00:01", 3, 5.0, 1.0),
            ("C", "Q", "2021-01-01 00:00", 4, 2.0, 1.0),   # a return exists
            ("C", "Q", "2021-01-01 00:01", 5, None, 1.0),
        ]
    )
    assert {r.base_currency for r in series.pairs_with_returns(df).collect()} == {"C"}
    assert {r.base_currency for r in series.candle_returns(df).collect()} == {"C"}


def test_hour_buckets_ignore_session_time_zone(spark, candles):
    """Candles inside the New York spring-forward gap stay in their wall-clock hour."""
    rows = [("X", "Q", f"2021-03-14 {h:02d}:{m:02d}", h * 100 + m, float(h * 100 + m + 1), 1.0)
            for h in (1, 2, 3) for m in (0, 30, 59)]
    df = candles(rows)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        full = {r.seq: r.prev_close for r in series.top_of_hour(series.candle_returns(df, slice_rows=None)).collect()}
        cheap = {r.seq: r.prev_close for r in series.top_of_hour_returns(df).collect()}
        bucketed = {r.seq: r.prev_close for r in series.lag_in_pair(df, slice_rows=2).collect()}
        plain = {r.seq: r.prev_close for r in series.lag_in_pair(df, slice_rows=None).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert cheap == full == {200: 160.0, 300: 260.0}
    assert bucketed == plain
