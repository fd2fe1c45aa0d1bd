"""Registered queries: key -> (spark, sf_dir) -> DataFrame over the fixture views.

Each query reads whole tables through ``candleframe.sources.fixtures`` and applies the
library's operators. At this outermost step only, floating columns are rounded to 6 decimals
(so engines that add in a different order still compare equal) and DATE columns are reported as
midnight timestamps, as the source tables store dates; the oracle does the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleframe.operators import (
    activity,
    classify,
    correlation,
    profile,
    rank_stats,
    sampling,
    series,
    setops,
    universe,
    volatility,
)
from candleframe.plans import extract, studies, universe_load
from candleframe.sources import candles as candle_src
from candleframe.sources import catalog as cat
from candleframe.session import checkpointed
from candleframe.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def round_binary(c, digits: int = 6):
    """Round the binary value: x * 10^d to the nearest integer (halves away from zero) / 10^d.

    ``F.round(x, d)`` rounds the shortest decimal string of x instead, so a value printed as
    ...5 but stored just below it rounds up there and down in most SQL engines.
    """
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def _report(f: T.StructField, digits: int):
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return round_binary(F.col(f.name), digits).alias(f.name)
    if isinstance(f.dataType, T.DateType):
        # Reported the way the source tables store calendar dates: timestamp at midnight.
        return F.col(f.name).cast("timestamp_ntz").alias(f.name)
    return F.col(f.name)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Report form of a query result: doubles rounded to ``digits`` decimals, dates as
    midnight timestamps; names and column order are kept."""
    return df.select(*[_report(f, digits) for f in df.schema.fields])


def register(key: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return run

    return deco


# --- volatility (daily candles) -------------------------------------------------------------


@register("daily_last")
def q_daily_last(spark, sf_dir):
    """Last candle of each pair-day."""
    return series.daily_last(fx.candles_daily(spark, sf_dir)).select(
        "base_currency", "quote_currency", "date", "open_time", "seq", "close", "volume",
        "classification",
    )


@register("daily_log_returns")
def q_daily_log_returns(spark, sf_dir):
    """Daily log returns of last-of-day closes."""
    return series.daily_log_returns(fx.candles_daily(spark, sf_dir)).select(
        "base_currency", "quote_currency", "date", "year", "classification", "close",
        "prev_close", "log_return",
    )


@register("annual_volatility")
def q_annual_volatility(spark, sf_dir):
    """Annualized stddev of daily log returns per pair-year (the flagship query)."""
    return volatility.annual_volatility(series.daily_log_returns(fx.candles_daily(spark, sf_dir)))


@register("rolling_volatility")
def q_rolling_volatility(spark, sf_dir):
    """30-row rolling annualized volatility, NULL below 10 observations."""
    return volatility.rolling_volatility(series.daily_log_returns(fx.candles_daily(spark, sf_dir)))


@register("top_rolling_series")
def q_top_rolling_series(spark, sf_dir):
    """The 4 longest rolling-volatility series."""
    return volatility.top_series(
        volatility.rolling_volatility(series.daily_log_returns(fx.candles_daily(spark, sf_dir)))
    )


# --- pair universe (pair-file names) -------------------------------------------------------

PAIR_TARGET_QUOTES = ("Q0", "Q1", "Q2")


def _pair_catalog(spark, sf_dir):
    return cat.pair_catalog(fx.pair_files(spark, sf_dir))


@register("pair_catalog")
def q_pair_catalog(spark, sf_dir):
    """Pair names parsed from BASE-QUOTE.parquet file names."""
    return _pair_catalog(spark, sf_dir).select("file_name", "base_currency", "quote_currency")


@register("quote_count_per_base")
def q_quote_count_per_base(spark, sf_dir):
    return universe.quote_count_per_base(_pair_catalog(spark, sf_dir))


@register("quote_count_histogram")
def q_quote_count_histogram(spark, sf_dir):
    return universe.quote_count_histogram(universe.quote_count_per_base(_pair_catalog(spark, sf_dir)))


@register("top_bases")
def q_top_bases(spark, sf_dir):
    return universe.top_bases(universe.quote_count_per_base(_pair_catalog(spark, sf_dir)))


@register("common_quotes")
def q_common_quotes(spark, sf_dir):
    catalog = _pair_catalog(spark, sf_dir)
    return universe.common_quotes(catalog, universe.top_bases(universe.quote_count_per_base(catalog)))


@register("existing_pairs")
def q_existing_pairs(spark, sf_dir):
    """Top bases x common quotes that exist as pair files."""
    return universe_load.universe_pairs(_pair_catalog(spark, sf_dir)).select(
        "file_name", "base_currency", "quote_currency"
    )


@register("bases_with_min_quotes")
def q_bases_with_min_quotes(spark, sf_dir):
    """Bases that trade against at least three quotes."""
    return universe.bases_with_quotes(_pair_catalog(spark, sf_dir), 3)


@register("complete_bases")
def q_complete_bases(spark, sf_dir):
    """Bases trading against all of Q0, Q1, Q2."""
    return universe.complete_bases(_pair_catalog(spark, sf_dir), PAIR_TARGET_QUOTES)


# --- load, classify, extract (daily candles) -----------------------------------------------

CANDLE_OUT = (
    "base_currency", "quote_currency", "open_time", "seq", "close", "volume",
    "quote_asset_volume", "number_of_trades", "classification",
)
BASE_LISTS = {"cryptos": ("AUTOMOBILE",), "stablecoins": ("BUILDING",), "fiats": ("FURNITURE",)}


@register("load_candles")
def q_load_candles(spark, sf_dir):
    """Candles of the universe (top bases x common quotes), classified by quote."""
    candles = fx.candles_daily(spark, sf_dir)
    # One small checkpointed table of pairs serves every branch of the universe.
    pairs = universe_load.universe_pairs(checkpointed(universe.distinct_pairs(candles)))
    return (
        candles.join(F.broadcast(pairs.select("base_currency", "quote_currency")), on=["base_currency", "quote_currency"], how="left_semi")
        .transform(lambda d: classify.classify_by_quote(d, fx.DAILY_QUOTE_CLASSES))
        .select(*CANDLE_OUT)
    )


def _with_fake_path(df):
    return df.withColumn(
        "_path", F.concat(F.lit("/data/pairs/"), F.col("base_currency"), F.lit("-"), F.col("quote_currency"), F.lit(".parquet"))
    )


@register("stock_column")
def q_stock_column(spark, sf_dir):
    """stock = stem of the file that each order was read from; base/quote split from it."""
    orders = fx.read_table(spark, sf_dir, "orders")
    # The table is one file, or a folder of part files under the table's name.
    own = F.regexp_extract("_metadata.file_path", r"([^/]+\.parquet)(?:/[^/]+)?$", 1)
    named = candle_src.with_stock_column(orders.withColumn("_in", own), "_in")
    return candle_src.split_stock(named).select(
        "stock", "base_currency", "quote_currency", F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("close")
    )


@register("union_pairs")
def q_union_pairs(spark, sf_dir):
    """Daily and hourly candle frames, columns in different orders, unioned by name."""
    cols = ["base_currency", "quote_currency", "open_time", "seq", "close", "volume"]
    daily = fx.candles_daily(spark, sf_dir).select(*cols)
    hourly = fx.candles_hourly(spark, sf_dir).select(*reversed(cols))
    return setops.union_pairs(daily, hourly)


@register("classify_by_quote")
def q_classify_by_quote(spark, sf_dir):
    df = fx.candles_daily(spark, sf_dir).drop("classification")
    return classify.classify_by_quote(df, fx.DAILY_QUOTE_CLASSES).select(
        "base_currency", "quote_currency", "open_time", "seq", "classification"
    )


@register("classify_by_base")
def q_classify_by_base(spark, sf_dir):
    df = fx.candles_daily(spark, sf_dir).drop("classification")
    return classify.classify_by_base(df, **BASE_LISTS).select(
        "base_currency", "quote_currency", "open_time", "seq", "classification"
    )


def _extract(spark, sf_dir):
    candles = candle_src.with_stock_column(_with_fake_path(fx.candles_daily(spark, sf_dir)), "_path")
    return extract.closing_price_extract(
        candles, universe.distinct_pairs(candles), stablecoins=BASE_LISTS["stablecoins"], fiats=BASE_LISTS["fiats"]
    )


@register("closing_price_extract")
def q_closing_price_extract(spark, sf_dir):
    return _extract(spark, sf_dir)


@register("closing_price_summary")
def q_closing_price_summary(spark, sf_dir):
    return profile.closing_price_summary(_extract(spark, sf_dir))


# --- profile and activity (daily candles) ------------------------------------------------

DAILY_TARGET_QUOTES = ("F", "O", "P")


@register("null_profile")
def q_null_profile(spark, sf_dir):
    return profile.null_profile(fx.candles_daily(spark, sf_dir))


@register("bases_per_quote_year")
def q_bases_per_quote_year(spark, sf_dir):
    return activity.bases_per_quote_year(fx.candles_daily(spark, sf_dir), DAILY_TARGET_QUOTES)


@register("distinct_years_bases")
def q_distinct_years_bases(spark, sf_dir):
    return profile.distinct_years_bases(fx.candles_daily(spark, sf_dir))


@register("closing_price_series")
def q_closing_price_series(spark, sf_dir):
    return profile.closing_price_series(fx.candles_daily(spark, sf_dir))


@register("annual_volatility_panels")
def q_annual_volatility_panels(spark, sf_dir):
    """Annual volatility of the first ten bases by name, and of each base's first six years.

    Over the supply view, where more nations trade, and over more years."""
    # The choice reads the small result twice more.
    annual = checkpointed(volatility.annual_volatility(series.daily_log_returns(fx.candles_supply(spark, sf_dir))))
    return profile.first_panels(annual)


# --- volume vs return (daily candles) ------------------------------------------------------


@register("daily_returns")
def q_daily_returns(spark, sf_dir):
    return series.daily_returns(fx.candles_daily(spark, sf_dir)).select(
        "base_currency", "quote_currency", "date", "volume", "return"
    )


@register("daily_returns_total_volume")
def q_daily_returns_total_volume(spark, sf_dir):
    """Daily returns with the day's summed volume."""
    return series.daily_returns(fx.candles_ticks(spark, sf_dir), volume_mode="sum").select(
        "base_currency", "quote_currency", "date", "volume", "return"
    )


@register("volume_return_spearman")
def q_volume_return_spearman(spark, sf_dir):
    """Spearman rho of daily volume vs daily return per pair, with n, p-value and -log10(p)."""
    stats = rank_stats.spearman(series.daily_returns(fx.candles_daily(spark, sf_dir)))
    return stats.withColumn("neg_log10_p", F.when(F.col("p_value") > 0, -F.log10("p_value")))


@register("volume_return_sampled")
def q_volume_return_sampled(spark, sf_dir):
    """Spearman statistics of the 3 seeded bases x 3 seeded quotes (the volume/return study)."""
    _, stats = studies.volume_return_study(fx.candles_daily(spark, sf_dir))
    return stats


@register("volume_return_grid")
def q_volume_return_grid(spark, sf_dir):
    """The seeded 3 x 3 (base, quote) grid with Spearman statistics; n = 0 where no data.

    Over the supply view, where many nations lack some of the quotes."""
    return studies.volume_return_grid(fx.candles_supply(spark, sf_dir))


@register("daily_last_unique_times")
def q_daily_last_unique_times(spark, sf_dir):
    """Last tick of each pair-day via the hash-aggregate path."""
    return series.daily_last(fx.candles_ticks(spark, sf_dir), hashed=True).select(
        "base_currency", "quote_currency", "date", "open_time", "seq", "close", "volume"
    )


@register("seeded_key_sample")
def q_seeded_key_sample(spark, sf_dir):
    """3 bases and 3 quotes chosen with seed 42."""
    # Both samples read one small checkpointed table of pairs with daily returns: one pass.
    rows = checkpointed(
        series.daily_returns(fx.candles_daily(spark, sf_dir)).select("base_currency", "quote_currency").distinct()
    )
    b = sampling.seeded_key_sample(rows, "base_currency").select(
        F.lit("base").alias("kind"), F.col("base_currency").alias("key_value"), "sample_hash"
    )
    q = sampling.seeded_key_sample(rows, "quote_currency").select(
        F.lit("quote").alias("kind"), F.col("quote_currency").alias("key_value"), "sample_hash"
    )
    return b.unionByName(q)


# --- candle returns, hourly activity (tick candles) ---------------------------------------


def _tick_returns(spark, sf_dir):
    return series.candle_returns(fx.candles_ticks(spark, sf_dir))


RETURN_OUT = ("base_currency", "quote_currency", "open_time", "seq", "year", "close", "prev_close", "return")


@register("candle_returns")
def q_candle_returns(spark, sf_dir):
    return _tick_returns(spark, sf_dir).select(*RETURN_OUT)


@register("top_of_hour_returns")
def q_top_of_hour_returns(spark, sf_dir):
    """Returns of minute-0 ticks, from the reduced frame (not a lag over every tick)."""
    return series.top_of_hour_returns(fx.candles_ticks(spark, sf_dir)).select(*RETURN_OUT)


@register("rolling_volatility_ticks")
def q_rolling_volatility_ticks(spark, sf_dir):
    """30-row rolling volatility of the returns between adjacent ticks."""
    return volatility.rolling_candle_volatility(fx.candles_ticks(spark, sf_dir))


@register("hourly_volume")
def q_hourly_volume(spark, sf_dir):
    return activity.hourly_volume(fx.candles_ticks(spark, sf_dir))


@register("hourly_volume_matrix")
def q_hourly_volume_matrix(spark, sf_dir):
    return activity.hourly_volume_matrix(fx.candles_ticks(spark, sf_dir))


@register("hour_return_correlation")
def q_hour_return_correlation(spark, sf_dir):
    return correlation.hour_return_correlation(_tick_returns(spark, sf_dir))


@register("hour_return_correlation_matrix")
def q_hour_return_correlation_matrix(spark, sf_dir):
    """Pair x hour matrix of the clipped hour/return correlation."""
    long = correlation.hour_return_correlation(_tick_returns(spark, sf_dir))
    return activity.pivot_hours(long, "corr_clipped")


# --- return correlation matrices (hourly candles) ----------------------------------------

HOURLY_QUOTES = ("U0", "U1", "U2")
HOURLY_BASES = ("click", "purchase", "view")
HOURLY_YEARS = (2023, 2024)


def _of_pairs(candles, bases, quotes):
    """Candles of the requested pairs only: selected before the lag, not after it."""
    return candles.where(F.col("base_currency").isin(list(bases)) & F.col("quote_currency").isin(list(quotes)))


def _hourly_returns(spark, sf_dir):
    return series.candle_returns(_of_pairs(fx.candles_hourly(spark, sf_dir), HOURLY_BASES, HOURLY_QUOTES))


@register("corr_across_quotes")
def q_corr_across_quotes(spark, sf_dir):
    return correlation.corr_across_quotes(
        _hourly_returns(spark, sf_dir), quotes=HOURLY_QUOTES, bases=HOURLY_BASES, years=HOURLY_YEARS
    )


@register("corr_across_bases")
def q_corr_across_bases(spark, sf_dir):
    return correlation.corr_across_bases(
        _hourly_returns(spark, sf_dir), quotes=HOURLY_QUOTES, bases=HOURLY_BASES, years=HOURLY_YEARS
    )


DAILY_CORR_QUOTES = ("F", "O", "P")
DAILY_CORR_BASES = ("AUTOMOBILE", "BUILDING", "MACHINERY")
DAILY_CORR_YEARS = tuple(range(1995, 2002))


def _daily_candle_returns(spark, sf_dir):
    return series.candle_returns(_of_pairs(fx.candles_daily(spark, sf_dir), DAILY_CORR_BASES, DAILY_CORR_QUOTES))


@register("corr_across_quotes_daily")
def q_corr_across_quotes_daily(spark, sf_dir):
    """Quote-by-quote return correlation per base over seven years of daily candles."""
    return correlation.corr_across_quotes(
        _daily_candle_returns(spark, sf_dir), quotes=DAILY_CORR_QUOTES, bases=DAILY_CORR_BASES, years=DAILY_CORR_YEARS
    )


@register("corr_across_bases_daily")
def q_corr_across_bases_daily(spark, sf_dir):
    """Base-by-base return correlation per quote over seven years of daily candles."""
    return correlation.corr_across_bases(
        _daily_candle_returns(spark, sf_dir), quotes=DAILY_CORR_QUOTES, bases=DAILY_CORR_BASES, years=DAILY_CORR_YEARS
    )


@register("corr_study_hourly")
def q_corr_study_hourly(spark, sf_dir):
    """The guarded correlation study on hourly candles: base check, then the quote grid."""
    across_quotes, _ = studies.return_correlation_study(
        fx.candles_hourly(spark, sf_dir), quotes=HOURLY_QUOTES, bases=HOURLY_BASES, years=HOURLY_YEARS, coarse=True
    )
    return across_quotes


def queries() -> dict[str, Query]:
    return dict(QUERIES)
