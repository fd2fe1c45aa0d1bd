"""DataFrame -> DataFrame operators over candle data (usable with ``DataFrame.transform``)."""

from candleframe.operators.activity import (
    bases_per_quote_year,
    hourly_volume,
    hourly_volume_matrix,
    pivot_hours,
)
from candleframe.operators.classify import classify_by_base, classify_by_quote
from candleframe.operators.correlation import (
    corr_across_bases,
    corr_across_quotes,
    hour_correlation_from_moments,
    hour_moments,
    hour_return_correlation,
    pairwise_correlation,
)
from candleframe.operators.profile import (
    closing_price_series,
    closing_price_statistics,
    closing_price_summary,
    distinct_years_bases,
    first_panels,
    null_profile,
)
from candleframe.operators.rank_stats import average_ranks, spearman
from candleframe.operators.sampling import seeded_key_sample
from candleframe.operators.series import (
    candle_returns,
    daily_last,
    daily_log_returns,
    daily_returns,
    lag_in_pair,
    log_returns_of_daily,
    pairs_with_returns,
    returns_of_daily,
    times_are_unique,
    top_of_hour,
    top_of_hour_returns,
)
from candleframe.operators.setops import union_pairs
from candleframe.operators.slices import cut_slices, with_halo
from candleframe.operators.universe import (
    bases_with_quotes,
    common_quotes,
    complete_bases,
    distinct_pairs,
    existing_pairs,
    file_size_totals,
    quote_count_histogram,
    quote_count_per_base,
    require_bases,
    top_bases,
)
from candleframe.operators.volatility import (
    annual_volatility,
    rolling_candle_volatility,
    rolling_volatility,
    top_series,
)

__all__ = [
    "annual_volatility",
    "average_ranks",
    "bases_per_quote_year",
    "bases_with_quotes",
    "candle_returns",
    "classify_by_base",
    "classify_by_quote",
    "closing_price_series",
    "closing_price_statistics",
    "closing_price_summary",
    "common_quotes",
    "complete_bases",
    "corr_across_bases",
    "corr_across_quotes",
    "cut_slices",
    "daily_last",
    "daily_log_returns",
    "daily_returns",
    "distinct_pairs",
    "distinct_years_bases",
    "existing_pairs",
    "file_size_totals",
    "first_panels",
    "hour_correlation_from_moments",
    "hour_moments",
    "hour_return_correlation",
    "hourly_volume",
    "hourly_volume_matrix",
    "lag_in_pair",
    "log_returns_of_daily",
    "null_profile",
    "pairs_with_returns",
    "pairwise_correlation",
    "pivot_hours",
    "quote_count_histogram",
    "quote_count_per_base",
    "require_bases",
    "returns_of_daily",
    "rolling_candle_volatility",
    "rolling_volatility",
    "seeded_key_sample",
    "spearman",
    "times_are_unique",
    "top_bases",
    "top_of_hour",
    "top_of_hour_returns",
    "top_series",
    "union_pairs",
    "with_halo",
]
