"""The notebook's studies as DataFrame functions (no plotting).

``volatility_measures`` returns (annual, rolling) volatility; ``volume_return_study``
returns the daily volume/return rows and the Spearman statistics of the sampled pairs;
``return_correlation_study`` checks the complete bases and returns both correlation grids;
``return_summaries`` + ``correlation_grids`` serve the grids and the hour correlation from one
pass of candle returns (as the whole-analysis report does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.operators.activity import pair_label
from candleframe.operators.correlation import corr_across_bases, corr_across_quotes
from candleframe.functions.time import hour_of_day
from candleframe.operators.rank_stats import spearman
from candleframe.operators.sampling import seeded_key_sample
from candleframe.operators.series import (
    candle_returns,
    daily_log_returns,
    daily_returns,
    pairs_with_returns,
    returns_of_daily,
    top_of_hour,
    top_of_hour_returns,
)
from candleframe.operators.universe import complete_bases, require_bases
from candleframe.operators.volatility import annual_volatility, rolling_volatility
from candleframe.session import checkpointed
from candleframe.schema import (
    ANNUALIZATION,
    BASE,
    CORR_BASES,
    CORR_QUOTES,
    CORR_YEARS,
    MIN_COMPLETE_BASES,
    MIN_ROLLING_OBS,
    QUOTE,
    ROLLING_WINDOW_ROWS,
    SAMPLE_SEED,
    SAMPLE_SIZE,
    TIME,
)


def volatility_measures(
    candles: DataFrame,
    *,
    rolling_window_days: int = ROLLING_WINDOW_ROWS,
    annualization_factor: float = ANNUALIZATION,
    min_rolling_obs: int = MIN_ROLLING_OBS,
) -> tuple[DataFrame, DataFrame]:
    """(annual, rolling) volatility from one daily-log-return frame (both lazy).

    To compute both outputs with one pass over the candles, persist
    ``daily_log_returns(candles)`` and apply the two operators to it, releasing it after the
    writes (as ``candleframe.plans.report.run_report`` does).
    """
    daily = daily_log_returns(candles)
    annual = annual_volatility(daily, annualization=annualization_factor)
    rolling = rolling_volatility(
        daily,
        window_rows=rolling_window_days,
        min_obs=min_rolling_obs,
        annualization=annualization_factor,
    )
    return annual, rolling


def _daily_rows(candles: DataFrame | None, daily: DataFrame | None) -> DataFrame:
    returns = returns_of_daily(daily) if daily is not None else daily_returns(candles)
    return returns.select(BASE, QUOTE, "date", "volume", "return")


def _sampled(rows: DataFrame, seed: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bases, quotes, Spearman statistics) of ``k`` seeded bases x ``k`` seeded quotes.

    Keys are drawn from the distinct pairs with daily returns, one small checkpointed table.
    Only rows of the sampled pairs are ranked: at most k x k pairs, by semi joins on lists of
    at most ``k`` rows.
    """
    pairs = checkpointed(rows.select(BASE, QUOTE).distinct())
    bases = seeded_key_sample(pairs, BASE, k, seed).select(BASE)
    quotes = seeded_key_sample(pairs, QUOTE, k, seed).select(QUOTE)
    picked = rows.join(F.broadcast(bases), on=BASE, how="left_semi").join(
        F.broadcast(quotes), on=QUOTE, how="left_semi"
    )
    return bases, quotes, spearman(picked)


def volume_return_study(
    candles: DataFrame | None = None,
    *,
    daily: DataFrame | None = None,
    seed: int = SAMPLE_SEED,
    k: int = SAMPLE_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """(daily rows, Spearman stats) for ``k`` seeded bases x ``k`` seeded quotes.

    Daily rows: base, quote, date, volume (of the day's last candle), return (lazy). Stats:
    one row per sampled base x quote that has data (n, rho, p_value). Pass ``daily`` (a
    ``daily_last`` table) instead of ``candles`` to reuse one.
    """
    rows = _daily_rows(candles, daily)
    return rows, _sampled(rows, seed, k)[2]


def volume_return_grid(
    candles: DataFrame | None = None,
    *,
    daily: DataFrame | None = None,
    seed: int = SAMPLE_SEED,
    k: int = SAMPLE_SIZE,
) -> DataFrame:
    """Spearman statistics for every cell of the seeded k x k (base, quote) grid.

    Cells whose pair has no daily returns are kept with ``n = 0`` and NULL statistics (the
    "no data" panels). The k sampled quotes are collected (at most k names) to lay out the
    grid by ``explode``, so no cross join is planned. Pass ``daily`` to reuse a ``daily_last``
    table.
    """
    rows = _daily_rows(candles, daily)
    bases, quotes, stats = _sampled(rows, seed, k)
    names = [r[QUOTE] for r in quotes.collect()]
    if not names:
        return stats.select(BASE, QUOTE, "n", "rho", "p_value").limit(0)
    grid = bases.withColumn(QUOTE, F.explode(F.array(*[F.lit(q) for q in names])))
    return (
        grid.join(stats, on=[BASE, QUOTE], how="left")
        .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint"))
        .select(BASE, QUOTE, "n", "rho", "p_value")
    )


def _grid_cell_time(quotes, bases):
    return F.when((F.minute(TIME) == 0) & F.col(QUOTE).isin(list(quotes)) & F.col(BASE).isin(list(bases)), F.col(TIME))


def checked_bases(candles: DataFrame, *, quotes=CORR_QUOTES, bases=CORR_BASES, minimum: int = MIN_COMPLETE_BASES) -> list[str]:
    """The requested bases, after the complete-base check; reads one lag-free aggregate."""
    targets = candles.where(F.col(QUOTE).isin(list(quotes)))
    complete = complete_bases(pairs_with_returns(targets), quotes)
    return require_bases(complete, bases, target_quotes=quotes, minimum=minimum)


def correlation_grids(
    summary: DataFrame, *, quotes=CORR_QUOTES, bases=CORR_BASES, years=CORR_YEARS
) -> tuple[DataFrame, DataFrame]:
    """Both grids from a correlation summary (see ``return_summaries``), for checked bases."""
    cells = summary.where(F.col(TIME).isNotNull())
    return (
        corr_across_quotes(cells, quotes=quotes, bases=bases, years=years),
        corr_across_bases(cells, quotes=quotes, bases=bases, years=years),
    )


def return_correlation_study(
    candles: DataFrame,
    *,
    quotes=CORR_QUOTES,
    bases=CORR_BASES,
    years=CORR_YEARS,
    minimum: int = MIN_COMPLETE_BASES,
    coarse: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(across quotes, across bases) correlation grids of top-of-hour candle returns.

    Raises ValueError, before any grid is built, when fewer than ``minimum`` bases trade
    against every quote or when a requested base does not. The check reads one lag-free
    aggregate (``pairs_with_returns``). Bases are a given short list: a grid has one aggregate
    for every two of them.

    The grids need returns of minute-0 candles only: ``top_of_hour_returns`` computes them
    from a frame of about 2/60 of minute candles instead of shuffling every candle, for the
    chosen pairs only. Their top-of-hour cells (mean return per pair and timestamp) are
    checkpointed and both grids read them. ``coarse=True`` (hourly or coarser candles, where
    every candle opens at minute 0) uses the sliced lag of all candles instead.
    """
    chosen = checked_bases(candles, quotes=quotes, bases=bases, minimum=minimum)
    chosen_candles = candles.where(F.col(QUOTE).isin(list(quotes)) & F.col(BASE).isin(chosen))
    returns = (
        top_of_hour(candle_returns(chosen_candles))
        if coarse
        else top_of_hour_returns(chosen_candles)
    )
    cells = checkpointed(
        returns.groupBy(BASE, QUOTE, "year", TIME).agg(F.avg("return").alias("return"))
    )
    return (
        corr_across_quotes(cells, quotes=quotes, bases=chosen, years=years),
        corr_across_bases(cells, quotes=quotes, bases=chosen, years=years),
    )


def return_summaries(
    candles: DataFrame, *, quotes=CORR_QUOTES, bases=CORR_BASES
) -> tuple[DataFrame, DataFrame]:
    """(correlation summary, hour moments) from ONE pass of candle returns.

    A single GROUPING SETS aggregation (one Expand, map-side partials) groups the returns by
    (pair, year, top-of-hour cell) for the correlation grids and by (pair, hour of day) for
    the hour correlation; the small result is checkpointed and split. Use with
    ``correlation_grids`` and ``hour_correlation_from_moments``.
    """
    r = candle_returns(candles).select(
        BASE,
        QUOTE,
        "year",
        _grid_cell_time(quotes, bases).alias("_cell"),
        hour_of_day(TIME).alias("hour_of_day"),
        "return",
    )
    both = checkpointed(
        r.groupingSets(
            [[BASE, QUOTE, "year", "_cell"], [BASE, QUOTE, "hour_of_day"]],
            BASE,
            QUOTE,
            "year",
            "_cell",
            "hour_of_day",
        ).agg(
            F.avg("return").alias("return"),
            F.count("return").alias("n_h"),
            F.var_pop("return").alias("var_h"),
            F.grouping("hour_of_day").alias("_by_cell"),
        )
    )
    summary = both.where((F.col("_by_cell") == 1) & F.col(QUOTE).isin(list(quotes))).select(
        BASE, QUOTE, "year", F.col("_cell").alias(TIME), "return"
    )
    moments = both.where((F.col("_by_cell") == 0) & (F.col("n_h") > 0)).select(
        pair_label().alias("pair"), "hour_of_day", "n_h", F.col("return").alias("mean_h"), "var_h"
    )
    return summary, moments
