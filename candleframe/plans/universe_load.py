"""Build the candle universe from a pair-file directory.

Catalog the directory, take the top bases by quote count and the quotes common to all of
them, keep the pair files that exist, and read them in one scan with pair columns and the
quote classification.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from candleframe.operators.classify import classify_by_quote
from candleframe.operators.universe import (
    common_quotes,
    existing_pairs,
    file_size_totals,
    quote_count_per_base,
    top_bases,
)
from candleframe.schema import QUOTE_CLASSES, TOP_BASES_NOTEBOOK
from candleframe.sources.candles import load_pair_files
from candleframe.sources.catalog import directory_catalog, list_parquet_files


def universe_pairs(catalog: DataFrame, top_n: int = TOP_BASES_NOTEBOOK) -> DataFrame:
    """Catalog rows of the top-``top_n`` bases x the quotes common to all of them.

    At most ``top_n`` x (number of common quotes) rows: safe to broadcast against candles.
    """
    top = top_bases(quote_count_per_base(catalog), top_n)
    return existing_pairs(catalog, top, common_quotes(catalog, top))


def load_universe(
    spark: SparkSession,
    directory: str,
    *,
    top_n: int = TOP_BASES_NOTEBOOK,
    classes: Mapping[str, Sequence[str]] = QUOTE_CLASSES,
) -> DataFrame:
    """Candles of the universe's pair files with base, quote and classification columns.

    The file paths are the only thing brought to the driver: the scan needs them to plan
    its splits, exactly as a directory listing would.
    """
    paths = [r.path for r in universe_pairs(directory_catalog(spark, directory), top_n).select("path").collect()]
    return classify_by_quote(load_pair_files(spark, paths), classes)


def universe_file_sizes(spark: SparkSession, directory: str, *, top_n: int = TOP_BASES_NOTEBOOK) -> DataFrame:
    """Bytes of the universe's pair files against all ``*.parquet`` files of the directory."""
    files = list_parquet_files(spark, directory)
    return file_size_totals(files, universe_pairs(directory_catalog(spark, directory), top_n))
