"""Slices of hot groups: lag, rolling frames, ranks and last candles equal their plain windows."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from candleframe.operators import rank_stats, series, slices, volatility
from candleframe.schema import PAIR_KEYS
from conftest import CANDLE_DDL, SF001

KEYS = list(PAIR_KEYS)
START = dt.datetime(2021, 3, 1)
LAX = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    """(base, microseconds or None, seq, close) rows as candles."""
    return spark.createDataFrame(
        [(b, "Q", None if m is None else START + dt.timedelta(microseconds=m), s, c, 1.0) for b, m, s, c in rows], CANDLE_DDL)


def ticks(spark):
    from candleframe.sources import fixtures as fx

    return fx.candles_ticks(spark, SF001)


def largest(cut, df):
    return cut.assign(cut.ordered(df)).groupBy(*KEYS, "_slice").count().agg(F.max("count"), F.count("*")).first()


@pytest.mark.parametrize("rows", [1, 50])
def test_no_slice_exceeds_twice_its_size(spark, rows):
    df = ticks(spark).withColumn("base_currency", F.lit("HOT")).withColumn("quote_currency", F.lit("Q"))
    n = df.count()
    most, count = largest(slices.cut_slices(df, KEYS, ["open_time", "seq"], rows), df)
    assert most <= 2 * rows and count >= n / (2 * rows)
    assert rows > 1 or count > 1_024


def test_slices_of_one_microsecond(spark):
    """100,000 candles of one pair and one microsecond are cut along seq, and lag like one window."""
    n = 100_000
    df = spark.range(n).select(
        F.lit("HOT").alias("base_currency"), F.lit("Q").alias("quote_currency"), F.lit(START).cast("timestamp_ntz").alias("open_time"),
        (F.pmod(F.col("id") * 7919, F.lit(n))).alias("seq"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("close")).repartition(8, "seq")
    most, count = largest(slices.cut_slices(df, KEYS, ["open_time", "seq"], 2_000), df)
    assert most <= 4_000 and count >= 25
    a = series.lag_in_pair(df, slice_rows=2_000).select("seq", "close", "prev_close")
    b = series.lag_in_pair(df, slice_rows=None).select("seq", "close", "prev_close")
    assert a.exceptAll(b).isEmpty() and a.count() == n


def test_ties_without_seq_are_cut_by_content(spark):
    df = spark.range(3_000).select(
        F.lit("HOT").alias("base_currency"), F.lit("Q").alias("quote_currency"), F.lit(START).cast("timestamp_ntz").alias("open_time"),
        F.col("id").cast("double").alias("close"))
    cut = slices.cut_slices(df, KEYS, ["open_time"], 100)
    assert cut.by_content and largest(cut, df)[0] <= 200
    got = series.lag_in_pair(df, slice_rows=100)
    assert got.columns == [*df.columns, "prev_close"]
    # One chain through all candles.
    rows = [(r.close, r.prev_close) for r in got.collect()]
    before = dict(rows)
    at, seen = next(c for c in before if c not in {p for _, p in rows}), 0
    while at is not None:
        seen, at = seen + 1, before[at]
    assert seen == len(rows) == 3_000


def test_equal_rows_end(spark):
    """Rows equal in every column cannot be cut; the cutting stops all the same."""
    df = frame(spark, [("A", 5, 1, 2.0)] * 40 + [("A", 9, 1, 3.0)])
    cut = slices.cut_slices(df, KEYS, ["open_time", "seq"], 4)
    assert largest(cut, df)[0] == 40
    got = Counter((r.close, r.prev_close) for r in series.lag_in_pair(df, slice_rows=4).collect())
    assert got == Counter({(2.0, 2.0): 39, (2.0, None): 1, (3.0, 2.0): 1})


candle_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", None]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=6)),
        st.one_of(st.none(), st.floats(min_value=-5, max_value=5, allow_nan=False)),
    ),
    min_size=1,
    max_size=60,
)


@LAX
@given(rows=candle_rows, size=st.integers(min_value=1, max_value=4))
def test_sliced_lag_with_ties_and_nulls(spark, rows, size):
    df = frame(spark, [(b, m, None if i % 11 == 7 else i, c) for i, (b, m, c) in enumerate(rows)])
    df = df.where("seq IS NOT NULL OR open_time IS NOT NULL")

    def of(n):
        return Counter((r.base_currency, r.open_time, r.seq, r.close, r.prev_close) for r in series.lag_in_pair(df, slice_rows=n).collect())

    # Two NULL seqs of a pair and time have no certain order: leave such data out.
    tied = df.where("seq IS NULL").groupBy(*KEYS, "open_time").count().where("count > 1")
    if tied.isEmpty():
        assert of(size) == of(None)


@pytest.mark.parametrize(("window", "size"), [(1, 3), (5, 2), (30, 50)])
def test_rolling_frames_on_candles(spark, window, size):
    df = ticks(spark)
    a = volatility.rolling_candle_volatility(df, window_rows=window, min_obs=1, slice_rows=size)
    b = volatility.rolling_candle_volatility(df, window_rows=window, min_obs=1, slice_rows=None)
    assert a.columns == b.columns
    got, want = ({(r.base_currency, r.quote_currency, r.seq): (r.rolling_count, r.rolling_vol_annualized) for r in x.collect()} for x in (a, b))
    assert got.keys() == want.keys() and len(got) > 900
    for k, (n, v) in want.items():
        assert got[k][0] == n and (got[k][1] == pytest.approx(v, rel=1e-9, abs=1e-12) if v is not None else got[k][1] is None)


def test_halo_passes_slices_shorter_than_it(spark):
    rng = random.Random(2)
    rows = [("A", m, i, rng.uniform(1, 2)) for i, m in enumerate(sorted([0] * 40 + [1, 2, 3] + [9] * 30 + list(range(10, 40))))]
    df = frame(spark, rows)
    for size in (1, 4):
        a, b = (volatility.rolling_candle_volatility(df, window_rows=12, min_obs=1, slice_rows=s).orderBy("seq").collect() for s in (size, None))
        assert [r.rolling_count for r in a] == [r.rolling_count for r in b]
        assert [r.rolling_vol_annualized for r in a[1:]] == pytest.approx([r.rolling_vol_annualized for r in b[1:]], rel=1e-9)


def test_rolling_volatility_of_days_in_slices(spark):
    from candleframe.sources import fixtures as fx

    daily = series.daily_log_returns(fx.candles_daily(spark, SF001))
    a, b = volatility.rolling_volatility(daily, slice_rows=40), volatility.rolling_volatility(daily)
    got, want = ({(r.base_currency, r.quote_currency, r.date): r for r in x.collect()} for x in (a, b))
    assert a.columns == b.columns and got.keys() == want.keys()
    for k, r in want.items():
        assert got[k].rolling_count == r.rolling_count
        assert got[k].rolling_vol_annualized == (pytest.approx(r.rolling_vol_annualized, rel=1e-9) if r.rolling_vol_annualized is not None else None)


# --- ranks -------------------------------------------------------------------------------------

value_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B", None]), st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 2.0, 3.0, float("inf")])),
              st.one_of(st.none(), st.integers(min_value=-4, max_value=4).map(float))),
    min_size=1, max_size=60)


def plain_spearman(df):
    ok = df.where("volume IS NOT NULL AND `return` IS NOT NULL")
    for c in ("volume", "return"):
        w = Window.partitionBy(*KEYS).orderBy(c)
        ok = ok.withColumn(f"_{c}", (F.rank().over(w) + F.count(F.lit(1)).over(w)) / 2.0)
    sd = F.stddev_pop("_volume") * F.stddev_pop("_return")
    return {r.base_currency: (r.n, r.rho) for r in ok.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.try_divide(F.covar_pop("_volume", "_return"), sd).alias("rho")).collect()}


@LAX
@given(rows=value_rows, size=st.sampled_from([1, 2, 5, 100_000]))
def test_sliced_spearman_equals_the_windows(spark, rows, size):
    df = spark.createDataFrame([(b, "Q", x, y) for b, x, y in rows], "base_currency string, quote_currency string, volume double, `return` double")
    got = {r.base_currency: (r.n, r.rho) for r in rank_stats.spearman(df, slice_rows=size).collect()}
    want = plain_spearman(df)
    assert got.keys() == {b for b, _, _ in rows}
    for b, (n, rho) in got.items():
        assert n == want.get(b, (0, None))[0]
        other = want.get(b, (0, None))[1]
        assert rho == (pytest.approx(other, abs=1e-9) if other is not None else None)


def test_ranks_of_a_hot_pair_spread(spark):
    """A third of the rows in one pair, a third of those with one value: no task ranks much of it."""
    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 50)).alias("base_currency"),
        F.lit("Q").alias("quote_currency"),
        F.when(F.col("id") % 9 == 0, 0.0).otherwise(F.rand(1) * 1_000).alias("volume"), F.randn(2).alias("return"))
    df = df.checkpoint()
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        rows = df.where("base_currency = 'HOT'").withColumn("w", F.lit(1))
        ranked = rank_stats.average_ranks(rows, "volume", "r", keys=KEYS, weight="w", slice_rows=500)
        sizes = [r["count"] for r in ranked.where("r > 0").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 0.2 * sum(sizes)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "windowspecdefinition(base_currency" not in plan or "_slice" in plan
        got = {r.base_currency: (r.n, r.rho) for r in rank_stats.spearman(df, slice_rows=500).collect()}
        want = plain_spearman(df)
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-9) for k in want)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# --- last candle of a period ---------------------------------------------------------------------

tied_rows = st.lists(
    st.tuples(st.sampled_from(["A", "B"]), st.one_of(st.none(), st.integers(min_value=0, max_value=3)),
              st.one_of(st.none(), st.integers(min_value=-(2**63), max_value=2**63 - 1))),
    min_size=1, max_size=30, unique=True)


@LAX
@given(rows=tied_rows)
def test_hashed_last_candle_equals_the_window(spark, rows):
    df = frame(spark, [(b, None if m is None else m * 40_000_000_000, s, float(i)) for i, (b, m, s) in enumerate(rows)])
    a, b = (Counter(map(tuple, series.daily_last(df, hashed=h).collect())) for h in (True, False))
    assert a == b


def test_hashed_last_candle_is_one_candle(spark):
    """Candles equal in time and seq: one of them is kept whole."""
    rows = [("A", 5, 1, float(i)) for i in range(200)]
    df = frame(spark, rows).withColumn("volume", F.col("close") * 10).repartition(7)
    (r,) = series.daily_last(df, hashed=True).collect()
    assert r.volume == 10 * r.close
    (r,) = series.daily_last(df.drop("seq"), hashed=True).collect()
    assert r.volume == 10 * r.close


def test_hashed_path_has_no_sort_and_one_shuffle(spark):
    df = frame(spark, [("A", 5, 1, 1.0)])
    plan = series.daily_last(df, hashed=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan and plan.count("Exchange") == 1


def test_log_returns_of_candles(spark):
    rows = [("A", 0, 1, 2.0), ("A", 1, 2, 0.0), ("A", 2, 3, 4.0), ("A", 3, 4, 8.0), ("A", 4, 5, 4.0)]
    got = volatility.rolling_candle_volatility(frame(spark, rows), min_obs=2).orderBy("seq").collect()
    assert [(r.seq, r.rolling_count) for r in got] == [(4, 1), (5, 2)]
    sd = math.sqrt(2) * math.log(2)
    assert got[0].rolling_vol_annualized is None and got[1].rolling_vol_annualized == pytest.approx(sd * math.sqrt(365))
