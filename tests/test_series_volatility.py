"""Daily series, returns and volatility on tiny literal fixtures."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from candleframe.operators import series, volatility

SQRT365 = math.sqrt(365)


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols[:3]).collect()]


def test_gap_days_window_counts_rows_not_days(candles):
    # Dates 01-01, 03-01, 03-02: the return on 03-01 spans two months.
    df = candles(
        [
            ("BTC", "USDT", "2021-01-01 10:00", 1, 100.0, 1.0),
            ("BTC", "USDT", "2021-03-01 10:00", 2, 110.0, 1.0),
            ("BTC", "USDT", "2021-03-02 10:00", 3, 121.0, 1.0),
        ]
    )
    lr = series.daily_log_returns(df)
    got = [(str(r.date), round(r.log_return, 12)) for r in lr.orderBy("date").collect()]
    assert got == [("2021-03-01", round(math.log(1.1), 12)), ("2021-03-02", round(math.log(1.1), 12))]
    roll = volatility.rolling_volatility(lr, window_rows=30, min_obs=1)
    assert [r.rolling_count for r in roll.orderBy("date").collect()] == [1, 2]


def test_single_day_pair_has_no_return_and_no_volatility(candles):
    df = candles([("ETH", "EUR", "2021-05-05 00:00", 1, 10.0, 1.0), ("ETH", "EUR", "2021-05-05 12:00", 2, 11.0, 1.0)])
    lr = series.daily_log_returns(df)
    assert lr.count() == 0
    assert volatility.annual_volatility(lr).count() == 0


def test_two_day_pair_volatility_row_dropped(candles):
    df = candles([("ETH", "EUR", "2021-05-05 00:00", 1, 10.0, 1.0), ("ETH", "EUR", "2021-05-06 00:00", 2, 11.0, 1.0)])
    lr = series.daily_log_returns(df)
    assert lr.count() == 1
    assert volatility.annual_volatility(lr).count() == 0


def test_tie_on_open_time_takes_highest_seq(candles):
    df = candles(
        [
            ("ADA", "BUSD", "2021-01-01 00:00", 7, 1.0, 5.0),
            ("ADA", "BUSD", "2021-01-01 00:00", 9, 2.0, 6.0),
            ("ADA", "BUSD", "2021-01-01 00:00", 8, 3.0, 7.0),
        ]
    )
    got = series.daily_last(df).collect()
    assert len(got) == 1 and got[0].seq == 9 and got[0].close == 2.0 and got[0].volume == 6.0
    # Deterministic regardless of input order and partitioning.
    got2 = series.daily_last(df.repartition(3).orderBy(F.rand(1))).collect()
    assert got2[0].seq == 9


def test_zero_and_negative_prices_give_null_not_errors(candles):
    df = candles(
        [
            ("X", "Q", "2021-01-01 00:00", 1, 0.0, 1.0),
            ("X", "Q", "2021-01-02 00:00", 2, 5.0, 1.0),
            ("X", "Q", "2021-01-03 00:00", 3, -5.0, 1.0),
            ("X", "Q", "2021-01-04 00:00", 4, 5.0, 1.0),
        ]
    )
    # Candle returns: prev 0 -> NULL return but the row stays (prev_close is not NULL).
    cr = series.candle_returns(df).orderBy("open_time").collect()
    assert [r["return"] for r in cr] == [None, -2.0, -2.0]
    # Daily simple returns drop NULL returns.
    assert series.daily_returns(df).count() == 2
    # Log returns: ratio <= 0 or prev 0 -> NULL -> dropped.
    assert series.daily_log_returns(df).count() == 0


def test_warm_up_first_nine_rolling_values_null(candles):
    closes = [100.0 * (1.01 ** i) * (1 + 0.02 * ((-1) ** i)) for i in range(13)]
    rows = [("BTC", "USDT", f"2021-01-{i + 1:02d} 00:00", i, c, 1.0) for i, c in enumerate(closes)]
    lr = series.daily_log_returns(candles(rows))
    roll = volatility.rolling_volatility(lr).orderBy("date").collect()
    assert len(roll) == 12
    assert [r.rolling_vol_annualized is None for r in roll] == [True] * 9 + [False] * 3
    assert [r.rolling_count for r in roll] == list(range(1, 13))
    # The 10th value is the sample stddev of the first 10 log returns, annualized.
    lrs = [math.log(closes[i + 1] / closes[i]) for i in range(10)]
    m = sum(lrs) / 10
    sd = math.sqrt(sum((x - m) ** 2 for x in lrs) / 9)
    assert roll[9].rolling_vol_annualized == pytest.approx(sd * SQRT365, rel=1e-12)


def test_rolling_window_is_thirty_rows(candles):
    rows = [("BTC", "USDT", f"2021-{1 + i // 28:02d}-{1 + i % 28:02d} 00:00", i, 100.0 + (i % 7), 1.0) for i in range(40)]
    roll = volatility.rolling_volatility(series.daily_log_returns(candles(rows)))
    assert roll.agg(F.max("rolling_count")).first()[0] == 30


def test_annual_volatility_value(candles):
    rows = [("BTC", "USDT", f"2021-01-{i + 1:02d} 12:00", i, c, 1.0) for i, c in enumerate([10.0, 11.0, 10.5, 12.0])]
    av = volatility.annual_volatility(series.daily_log_returns(candles(rows))).first()
    lrs = [math.log(11 / 10), math.log(10.5 / 11), math.log(12 / 10.5)]
    m = sum(lrs) / 3
    sd = math.sqrt(sum((x - m) ** 2 for x in lrs) / 2)
    assert av.n_days == 3 and av.year == 2021
    assert av.annual_volatility == pytest.approx(sd * SQRT365, rel=1e-12)


def test_top_series_orders_by_length_then_name(candles):
    rows = []
    for b, n in (("A", 3), ("B", 5), ("C", 5), ("D", 2), ("E", 4)):
        rows += [(b, "Q", f"2021-01-{d + 1:02d} 00:00", d, 1.0 + d, 1.0) for d in range(n)]
    top = volatility.top_series(series.daily_log_returns(candles(rows)))
    assert [(r.base_currency, r.n) for r in top.collect()] == [("B", 4), ("C", 4), ("E", 3), ("A", 2)]


@pytest.mark.parametrize("rows", [1_000_000, 400, 50, 3])
def test_sliced_lag_equals_plain_lag(spark, rows):
    from candleframe.sources import fixtures as fx

    from conftest import SF001

    ticks = fx.candles_ticks(spark, SF001)
    plain = series.lag_in_pair(ticks, slice_rows=None).select("seq", F.col("prev_close").alias("p"))
    bucketed = series.lag_in_pair(ticks, slice_rows=rows).select(
        "seq", F.col("prev_close").alias("b")
    )
    j = plain.join(bucketed, "seq", "full")
    assert j.count() == ticks.count()
    assert j.where(~F.col("p").eqNullSafe(F.col("b"))).count() == 0


def test_sliced_lag_crosses_gaps(candles):
    df = candles(
        [
            ("X", "Q", "2021-01-01 10:00", 1, 1.0, 1.0),
            ("X", "Q", "2021-01-01 10:30", 2, 2.0, 1.0),
            ("X", "Q", "2021-01-05 03:00", 3, 3.0, 1.0),  # several empty hours and days before
            ("Y", "Q", "2021-01-05 03:10", 4, 9.0, 1.0),
        ]
    )
    got = {r.seq: r.prev_close for r in series.lag_in_pair(df, slice_rows=1).collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: None}


def test_unique_time_fast_path_equals_window(spark):
    from candleframe.sources import fixtures as fx

    from conftest import SF001

    ticks = fx.candles_ticks(spark, SF001)  # all timestamps distinct
    cols = ["base_currency", "quote_currency", "date", "open_time", "seq", "close", "volume"]
    a = series.daily_last(ticks).select(*cols)
    b = series.daily_last(ticks, hashed=True).select(*cols)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Window" not in plan


def test_empty_input_gives_empty_results_with_schema(candles):
    empty = candles([])
    lr = series.daily_log_returns(empty)
    av = volatility.annual_volatility(lr)
    roll = volatility.rolling_volatility(lr)
    assert av.count() == 0 and roll.count() == 0 and series.candle_returns(empty).count() == 0
    assert av.columns == ["base_currency", "quote_currency", "year", "annual_volatility", "n_days"]
    assert roll.columns == ["base_currency", "quote_currency", "date", "rolling_vol_annualized", "rolling_count"]


def test_volatility_measures_equal_the_operators(spark):
    from candleframe.plans import studies
    from candleframe.sources import fixtures as fx

    from conftest import SF0001

    candles = fx.candles_daily(spark, SF0001)
    annual, rolling = studies.volatility_measures(candles)
    lr = series.daily_log_returns(candles)
    assert annual.exceptAll(volatility.annual_volatility(lr)).count() == 0
    assert rolling.exceptAll(volatility.rolling_volatility(lr)).count() == 0
    assert annual.count() > 0 and rolling.count() > 0


def test_times_are_unique_check(spark, candles):
    from candleframe.sources import fixtures as fx

    from conftest import SF001

    assert series.times_are_unique(fx.candles_ticks(spark, SF001))
    assert not series.times_are_unique(fx.candles_daily(spark, SF001))
    assert series.times_are_unique(candles([("A", "Q", "2021-01-01 00:00", 1, 1.0, 1.0), ("B", "Q", "2021-01-01 00:00", 2, 1.0, 1.0)]))


def test_daily_table_entry_points_equal_candle_entry_points(spark):
    from candleframe.plans import studies
    from candleframe.sources import fixtures as fx

    from conftest import SF0001

    candles = fx.candles_daily(spark, SF0001)
    daily = series.daily_last(candles)
    assert series.log_returns_of_daily(daily).exceptAll(series.daily_log_returns(candles)).count() == 0
    assert series.returns_of_daily(daily).exceptAll(series.daily_returns(candles)).count() == 0
    a = studies.volume_return_grid(candles)
    b = studies.volume_return_grid(daily=daily)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_unique_time_path_is_a_hash_aggregate(spark):
    """With the string classification of a real universe: no sort in the plan."""
    from candleframe.operators import classify
    from candleframe.sources import fixtures as fx

    from conftest import SF001

    ticks = classify.classify_by_quote(fx.candles_ticks(spark, SF001), {"stablecoin": ("U0",)})
    plan = series.daily_last(ticks, hashed=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_daily_volume_modes(candles):
    df = candles([
        ("X", "Q", "2021-01-01 10:00", 1, 1.0, 3.0),
        ("X", "Q", "2021-01-01 11:00", 2, 2.0, 4.0),
        ("X", "Q", "2021-01-02 10:00", 3, 2.0, None),
    ])
    last = {r.seq: r.volume for r in series.daily_last(df).collect()}
    total = {r.seq: r.volume for r in series.daily_last(df, volume_mode="sum").collect()}
    assert last == {2: 4.0, 3: None} and total == {2: 7.0, 3: None}
    with pytest.raises(ValueError):
        series.daily_last(df, volume_mode="mean")
