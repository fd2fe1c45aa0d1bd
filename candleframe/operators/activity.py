"""Trading activity: bases per quote and year, hourly volume profile, hour pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleframe.functions.time import hour_of_day, year_of
from candleframe.schema import BASE, QUOTE, TIME, YEAR_QUOTES

HOURS = tuple(range(24))


def pair_label() -> Column:
    """``BASE-QUOTE``."""
    return F.concat_ws("-", F.col(BASE), F.col(QUOTE))


def hour_column(h: int) -> str:
    return f"h{h:02d}"


def bases_per_quote_year(df: DataFrame, target_quotes: Sequence[str] = YEAR_QUOTES) -> DataFrame:
    """(year, quote_currency, n_base_currencies) for the target quotes.

    The quote filter reaches the Parquet scan; the distinct count is planned as a partial
    aggregate on (year, quote, base) per task before the shuffle.
    """
    return (
        df.where(F.col(QUOTE).isin(list(target_quotes)))
        .withColumn("year", year_of(TIME))
        .groupBy("year", QUOTE)
        .agg(F.countDistinct(BASE).alias("n_base_currencies"))
    )


def hourly_volume(df: DataFrame) -> DataFrame:
    """(pair, hour_of_day, avg_volume): mean candle volume per pair and hour of day."""
    return (
        df.select(pair_label().alias("pair"), hour_of_day(TIME).alias("hour_of_day"), "volume")
        .groupBy("pair", "hour_of_day")
        .agg(F.avg("volume").alias("avg_volume"))
    )


def pivot_hours(long: DataFrame, value: str, index: str = "pair") -> DataFrame:
    """Long (index, hour_of_day, value) with unique keys -> one row per index, h00..h23.

    Explicit pivot values make the 24 columns exist even for hours without data (NULL).
    The input is already aggregated (pairs x 24 rows), so this second aggregation is small.
    Rows are ordered by ``index``.
    """
    wide = long.groupBy(index).pivot("hour_of_day", list(HOURS)).agg(F.first(value))
    return wide.select(index, *[F.col(f"`{h}`").alias(hour_column(h)) for h in HOURS]).orderBy(index)


def hourly_volume_matrix(df: DataFrame) -> DataFrame:
    """Pair x hour matrix of log1p(average volume); absent hours are NULL."""
    wide = pivot_hours(hourly_volume(df), "avg_volume")
    return wide.select("pair", *[F.log1p(hour_column(h)).alias(hour_column(h)) for h in HOURS])
