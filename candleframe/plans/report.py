"""The whole candle analysis over a pair-file directory, each result written as Parquet.

    python -m candleframe.plans.report PAIR_DIR OUT_DIR [--top-n 10] [--corr-quotes BUSD,EUR,USDT]
        [--corr-bases ADA,ETH,BTC] [--years data|2017-2022] [--year-quotes ...] [--overwrite]

Runs, in order: pair catalog (quote-count histogram, top bases, common quotes, file sizes),
universe load, null profile, bases per quote and year, the guarded return-correlation
grids, annual and rolling volatility, the seeded volume/return grid, the hourly volume
matrix, the hour-of-day return correlation and the closing-price series. Every table is a
distributed DataFrame written by executors; nothing but small guard lists reaches the driver.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from candleframe.operators.activity import bases_per_quote_year, hourly_volume_matrix
from candleframe.operators.correlation import hour_correlation_from_moments
from candleframe.operators.profile import closing_price_series, null_profile
from candleframe.operators.series import daily_last, log_returns_of_daily
from candleframe.operators.universe import (
    common_quotes,
    quote_count_histogram,
    quote_count_per_base,
    top_bases,
)
from candleframe.operators.volatility import annual_volatility, rolling_volatility, top_series
from candleframe.plans.studies import checked_bases, correlation_grids, return_summaries, volume_return_grid
from candleframe.plans.universe_load import load_universe, universe_file_sizes
from candleframe.schema import (
    CORR_BASES,
    CORR_QUOTES,
    SAMPLE_SEED,
    TOP_BASES_NOTEBOOK,
    YEAR_QUOTES,
)
from candleframe.session import checkpointed
from candleframe.sources.catalog import directory_catalog


def run_report(
    spark: SparkSession,
    pair_dir: str,
    out_dir: str,
    *,
    top_n: int = TOP_BASES_NOTEBOOK,
    year_quotes: Sequence[str] = YEAR_QUOTES,
    corr_quotes: Sequence[str] = CORR_QUOTES,
    corr_bases: Sequence[str] = CORR_BASES,
    years: Sequence[int] | None = None,
    seed: int = SAMPLE_SEED,
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Run every analysis and write each table under ``out_dir``; returns name -> path.

    ``years=None`` correlates every year of the data.
    """
    written: dict[str, str] = {}

    def save(name: str, df: DataFrame) -> None:
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        written[name] = path

    catalog = directory_catalog(spark, pair_dir)
    counts = quote_count_per_base(catalog)
    top = top_bases(counts, top_n)
    save("quote_count_histogram", quote_count_histogram(counts))
    save("top_bases", top)
    save("common_quotes", common_quotes(catalog, top))
    save("file_sizes", universe_file_sizes(spark, pair_dir, top_n=top_n))

    candles = load_universe(spark, pair_dir, top_n=top_n)
    # The guard reads one narrow aggregate, before any expensive pass.
    chosen = checked_bases(candles, quotes=corr_quotes, bases=corr_bases)
    save("null_profile", null_profile(candles))
    save("bases_per_quote_year", bases_per_quote_year(candles, year_quotes))

    # One pass of candle returns feeds both the correlation grids and the hour correlation.
    corr_summary, hour_stats = return_summaries(candles, quotes=corr_quotes, bases=chosen)
    across_quotes, across_bases = correlation_grids(corr_summary, quotes=corr_quotes, bases=chosen, years=years)
    save("corr_across_quotes", across_quotes)
    save("corr_across_bases", across_bases)
    save("hour_return_correlation", hour_correlation_from_moments(hour_stats))

    # The volatility and volume/return analyses share one last-of-day table (one row per
    # pair-day, far smaller than the candles), checkpointed in the shared folder.
    daily = checkpointed(daily_last(candles, hashed=True))
    log_returns = log_returns_of_daily(daily)
    rolling = rolling_volatility(log_returns)
    save("annual_volatility", annual_volatility(log_returns))
    save("rolling_volatility", rolling)
    save("top_rolling_series", top_series(rolling))
    save("volume_return_grid", volume_return_grid(daily=daily, seed=seed))

    save("hourly_volume_matrix", hourly_volume_matrix(candles))
    save("closing_price_series", closing_price_series(candles))
    return written


def _names(text: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in text.split(",") if x.strip())


def _years(text: str) -> tuple[int, ...] | None:
    """'2017-2022', '2019,2021' or 'data' (the years present)."""
    if text == "data":
        return None
    if "-" in text:
        lo, hi = (int(x) for x in text.split("-", 1))
        return tuple(range(lo, hi + 1))
    return tuple(int(x) for x in _names(text))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("pair_dir")
    ap.add_argument("out_dir")
    ap.add_argument("--top-n", type=int, default=TOP_BASES_NOTEBOOK)
    ap.add_argument("--year-quotes", default=",".join(YEAR_QUOTES))
    ap.add_argument("--corr-quotes", default=",".join(CORR_QUOTES))
    ap.add_argument("--corr-bases", default=",".join(CORR_BASES))
    ap.add_argument("--years", default="data", help="'data' (every year present), '2017-2022' or a list")
    ap.add_argument("--seed", type=int, default=SAMPLE_SEED)
    ap.add_argument("--overwrite", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    out = run_report(
        spark,
        args.pair_dir,
        args.out_dir,
        top_n=args.top_n,
        year_quotes=_names(args.year_quotes),
        corr_quotes=_names(args.corr_quotes),
        corr_bases=_names(args.corr_bases),
        years=_years(args.years),
        seed=args.seed,
        mode="overwrite" if args.overwrite else "errorifexists",
    )
    for name, path in out.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
