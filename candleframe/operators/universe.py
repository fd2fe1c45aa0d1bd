"""Pair universe: quote counts, top bases, common quotes, existing pairs, complete bases.

Inputs are pair catalogs: any frame with base_currency / quote_currency (one row per pair
file, or per candle). Everything stays a DataFrame; only ``require_bases`` collects, and only
names that its parameters bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.schema import BASE, MIN_COMPLETE_BASES, PAIR_KEYS, QUOTE, TOP_BASES_NOTEBOOK


def distinct_pairs(df: DataFrame) -> DataFrame:
    """The pair catalog of a candle frame: distinct (base_currency, quote_currency)."""
    return df.select(*PAIR_KEYS).distinct()


def quote_count_per_base(catalog: DataFrame) -> DataFrame:
    """(base_currency, quote_count): number of distinct quotes each base trades against."""
    return catalog.groupBy(BASE).agg(F.countDistinct(QUOTE).alias("quote_count"))


def quote_count_histogram(counts: DataFrame) -> DataFrame:
    """(quote_count, n_bases): how many bases have each number of quotes."""
    return (
        counts.groupBy("quote_count")
        .agg(F.count(F.lit(1)).alias("n_bases"))
        .orderBy("quote_count")
    )


def top_bases(counts: DataFrame, n: int = TOP_BASES_NOTEBOOK) -> DataFrame:
    """The ``n`` bases with most quotes; ties by base name (TakeOrderedAndProject)."""
    return counts.orderBy(F.col("quote_count").desc(), F.col(BASE)).limit(n)


def common_quotes(catalog: DataFrame, bases: DataFrame) -> DataFrame:
    """Quotes that every base in ``bases`` trades against (set intersection as one aggregate).

    The number of bases is a scalar subquery, so no cross join and no collect.
    """
    b = bases.select(BASE).distinct()
    n_bases = b.select(F.count(F.lit(1))).scalar()
    return (
        catalog.join(b, on=BASE, how="left_semi")
        .groupBy(QUOTE)
        .agg(F.countDistinct(BASE).alias("_n"))
        .where(F.col("_n") == n_bases)
        .select(QUOTE)
    )


def existing_pairs(catalog: DataFrame, bases: DataFrame, quotes: DataFrame) -> DataFrame:
    """Catalog rows whose base is in ``bases`` and quote in ``quotes``.

    Same set as testing every (base, quote) of the product for existence, without building
    the product: two semi joins against small frames.
    """
    return catalog.join(bases.select(BASE), on=BASE, how="left_semi").join(
        quotes.select(QUOTE), on=QUOTE, how="left_semi"
    )


def complete_bases(df: DataFrame, target_quotes: Sequence[str]) -> DataFrame:
    """Bases that trade against every quote in ``target_quotes`` (relational division).

    ``collect_set`` runs after the IN filter, so each set holds at most len(target_quotes)
    values, and partial sets merge map-side.
    """
    targets = list(dict.fromkeys(target_quotes))
    return (
        df.where(F.col(QUOTE).isin(targets))
        .groupBy(BASE)
        .agg(F.collect_set(QUOTE).alias("quotes"))
        .where(F.size("quotes") == len(targets))
        .select(BASE)
    )


def require_bases(
    complete: DataFrame,
    desired: Sequence[str],
    *,
    target_quotes: Sequence[str] = (),
    minimum: int = MIN_COMPLETE_BASES,
) -> list[str]:
    """Check the complete-base set; return ``desired`` in its order.

    Raises ValueError when fewer than ``minimum`` bases are complete or a ``desired`` base is
    not. The driver gets at most ``minimum`` rows and the desired names; an error names the
    desired bases without all pairs and at most ten that have them.
    """
    names = complete.select(BASE).distinct()
    quotes = ", ".join(target_quotes)
    if len(names.limit(minimum).collect()) < minimum:
        raise ValueError(f"the analysis needs {minimum} bases quoted in each of {quotes}; there are {names.count()}")
    wanted = list(dict.fromkeys(desired))
    found = {r[BASE] for r in names.where(F.col(BASE).isin(wanted)).collect()}
    absent = [b for b in wanted if b not in found]
    if absent:
        some = [r[BASE] for r in names.orderBy(BASE).limit(10).collect()]
        raise ValueError(f"not quoted in each of {quotes}: {', '.join(absent)}; bases that are (first ten): {', '.join(some)}")
    return wanted


def bases_with_quotes(catalog: DataFrame, min_quotes: int) -> DataFrame:
    """Bases that trade against at least ``min_quotes`` distinct quotes: (base, quote_count)."""
    return quote_count_per_base(catalog).where(F.col("quote_count") >= min_quotes)


def file_size_totals(files: DataFrame, selected: DataFrame) -> DataFrame:
    """One row: bytes of the ``selected`` files, bytes of all ``files``, percent, MB and GB.

    ``files`` is a listing with (file_name, bytes); ``selected`` names files to count (e.g.
    the universe pairs). A conditional sum over one left join to the distinct selection.
    """
    flagged = files.join(
        selected.select("file_name").distinct().withColumn("_sel", F.lit(True)),
        on="file_name",
        how="left",
    )
    sel_bytes = F.sum(F.when(F.col("_sel"), F.col("bytes")).otherwise(F.lit(0))).cast("bigint")
    all_bytes = F.sum("bytes").cast("bigint")
    return flagged.agg(sel_bytes.alias("selected_bytes"), all_bytes.alias("all_bytes")).select(
        "selected_bytes",
        "all_bytes",
        F.try_divide(F.col("selected_bytes") * 100.0, F.col("all_bytes")).alias("pct_selected"),
        (F.col("selected_bytes") / (1024.0 * 1024.0)).alias("selected_mb"),
        (F.col("selected_bytes") / (1024.0**3)).alias("selected_gb"),
        (F.col("all_bytes") / (1024.0**3)).alias("all_gb"),
    )
