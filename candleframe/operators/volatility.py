"""Annual and rolling volatility of daily log returns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleframe.functions.returns import log_return
from candleframe.operators.series import lag_in_pair
from candleframe.operators.slices import SLICE_ROWS, cut_slices, with_halo
from candleframe.schema import ANNUALIZATION, MIN_ROLLING_OBS, PAIR_KEYS, ROLLING_WINDOW_ROWS, order_columns


def _class_col(df: DataFrame) -> list[str]:
    return ["classification"] if "classification" in df.columns else []


def annual_volatility(
    log_returns: DataFrame, *, annualization: float = ANNUALIZATION
) -> DataFrame:
    """Sample stddev of daily log returns x ``annualization`` per (pair, year, classification).

    Groups with a single return (stddev NULL) are dropped. Hash aggregate with map-side
    partials; the group count is pairs x years, so the final sort is small.
    """
    keys = [*PAIR_KEYS, "year", *_class_col(log_returns)]
    return (
        log_returns.groupBy(*keys)
        .agg(
            (F.stddev_samp("log_return") * F.lit(annualization)).alias("annual_volatility"),
            F.count("log_return").alias("n_days"),
        )
        .where(F.col("annual_volatility").isNotNull())
        .orderBy(*PAIR_KEYS, "year")
    )


def rolling_volatility(
    log_returns: DataFrame,
    *,
    window_rows: int = ROLLING_WINDOW_ROWS,
    min_obs: int = MIN_ROLLING_OBS,
    annualization: float = ANNUALIZATION,
    order: Sequence[str] = ("date",),
    slice_rows: int | None = None,
) -> DataFrame:
    """Rolling sample stddev over the last ``window_rows`` returns in ``order`` (rows, not days).

    ``rolling_count`` counts the non-NULL returns in the frame; the annualized value is NULL
    below ``min_obs``. Both share one window spec: one shuffle, one sort.

    Daily returns (at most 366 rows per pair-year) are one window per pair. For finer ones give
    ``slice_rows``: pairs of more than twice as many rows are cut into slices, each of which also
    gets the ``window_rows - 1`` rows before it, whose own results are dropped; the result
    is the same. ``log_returns`` is then read a few times.
    """
    keys = list(PAIR_KEYS)
    slices = None if slice_rows is None else cut_slices(log_returns, keys, order, slice_rows)
    rows, part, order_by = log_returns, keys, list(order)
    if slices is not None and slices.levels:
        rows = with_halo(slices.assign(slices.ordered(log_returns)), slices, window_rows - 1)
        part, order_by = [*keys, "_slice"], slices.order_by
    w = (
        Window.partitionBy(*part)
        .orderBy(*order_by)
        .rowsBetween(-(window_rows - 1), Window.currentRow)
    )
    std = F.stddev_samp("log_return").over(w)
    cnt = F.count("log_return").over(w)
    rolled = rows.withColumn("rolling_count", cnt).withColumn(
        "rolling_vol_annualized",
        F.when(F.col("rolling_count") >= min_obs, std * F.lit(annualization)),
    )
    if part != keys:
        rolled = rolled.where(F.col("_halo") == 0)
    return rolled.select(*keys, *order, "rolling_vol_annualized", "rolling_count", *_class_col(log_returns))


def rolling_candle_volatility(
    candles: DataFrame,
    *,
    window_rows: int = ROLLING_WINDOW_ROWS,
    min_obs: int = MIN_ROLLING_OBS,
    annualization: float = ANNUALIZATION,
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """``rolling_volatility`` of the log returns between adjacent candles, for pairs of any length.

    Candles without a log return (a pair's first one, a price of zero) are left out of the
    frames. ``slice_rows`` bounds the slices of the lag and of the frames alike.
    """
    returns = lag_in_pair(candles, slice_rows=slice_rows).withColumn("log_return", log_return())
    return rolling_volatility(
        returns.where(F.col("log_return").isNotNull()), window_rows=window_rows, min_obs=min_obs,
        annualization=annualization, order=order_columns(candles), slice_rows=slice_rows,
    )


def top_series(series: DataFrame, n: int = 4) -> DataFrame:
    """The ``n`` pairs with the most rows (ties by name): (base, quote, n)."""
    return (
        series.groupBy(*PAIR_KEYS)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), *PAIR_KEYS)
        .limit(n)
    )
