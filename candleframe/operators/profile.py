"""Data profiling and plain series extracts: null counts, years per base, closing prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleframe.functions.time import trade_date, year_of
from candleframe.schema import BASE, PANEL_BASES, PANEL_YEARS, QUOTE, TIME


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, n_null) per column: SQL NULLs only (NaN is a value, not NULL).

    One global aggregate (partial per task), then unpivoted to one row per column.
    """
    rows = F.count(F.lit(1))
    missing = df.agg(*[(rows - F.count(c)).alias(c) for c in df.columns])
    return missing.unpivot([], df.columns, "column_name", "n_null")


def distinct_years_bases(df: DataFrame) -> DataFrame:
    """Distinct (base_currency, year) with ``year_rank`` = 1 for each base's first year.

    The ranking window runs on the distinct pairs (bases x years rows), not on candles.
    """
    yb = df.select(BASE, year_of(TIME).alias("year")).distinct()
    w = Window.partitionBy(BASE).orderBy("year")
    return yb.withColumn("year_rank", F.dense_rank().over(w).cast("bigint"))


def closing_price_series(df: DataFrame) -> DataFrame:
    """(base, year, quote, date, close) of every candle: a projection, no shuffle."""
    return df.select(BASE, year_of(TIME).alias("year"), QUOTE, trade_date(TIME).alias("date"), "close")


def first_panels(df: DataFrame, *, bases: int = PANEL_BASES, years: int = PANEL_YEARS) -> DataFrame:
    """Rows of the first ``bases`` bases in name order, and of each base's first ``years`` years.

    ``df`` carries base_currency and ``year`` (none of them NULL is chosen). Chosen from the
    distinct (base, year) pairs; what is broadcast back has at most ``bases * years`` rows.
    """
    pairs = df.select(BASE, "year").where(F.col(BASE).isNotNull() & F.col("year").isNotNull()).distinct()
    first = pairs.select(BASE).distinct().orderBy(BASE).limit(bases)
    w = Window.partitionBy(BASE).orderBy("year")
    chosen = (
        pairs.join(F.broadcast(first), on=BASE, how="left_semi")
        .withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= years).drop("_rank")
    )
    return df.join(F.broadcast(chosen), on=[BASE, "year"], how="left_semi").select(*df.columns)


def closing_price_statistics() -> list[Column]:
    """Mean, sample stddev, min and max of ``close``: aggregates, also for ``observe``."""
    return [
        F.mean("close").alias("mean_close"),
        F.stddev("close").alias("std_close"),
        F.min("close").alias("min_close"),
        F.max("close").alias("max_close"),
    ]


def closing_price_summary(df: DataFrame) -> DataFrame:
    """``closing_price_statistics`` of all rows (one row)."""
    return df.agg(*closing_price_statistics())
