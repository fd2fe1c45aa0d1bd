"""Pair-file catalog: list ``BASE-QUOTE.parquet`` files and parse the pair from the name.

The pair exists only in the file name. Listing uses the ``binaryFile`` source with the
``content`` column pruned, so only file-system metadata (path, length) is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A pair file name: BASE-QUOTE.parquet (the quote is the second dash-separated field).
PARQUET_SUFFIX = r"\.parquet$"


def list_parquet_files(spark: SparkSession, directory: str) -> DataFrame:
    """(path, file_name, length) of every ``*.parquet`` file directly in ``directory``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(directory)
        .select(
            "path",
            F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
            F.col("length").alias("bytes"),
        )
    )


def file_stem(name) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(name, PARQUET_SUFFIX, "")


def parse_pair(name="file_name") -> tuple[Column, Column]:
    """(base, quote) from ``BASE-QUOTE.parquet``; '' when a field is missing.

    ``split_part`` returns '' out of range, whereas ``split(...)[1]`` raises under ANSI.
    """
    stem = file_stem(name)
    return F.split_part(stem, F.lit("-"), F.lit(1)), F.split_part(stem, F.lit("-"), F.lit(2))


def pair_catalog(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add base_currency / quote_currency parsed from ``name``; names without a pair are dropped.

    A file whose name has no ``-`` (or an empty side) names no pair: the loop this replaces
    would fail on it, here it is left out of the catalog.
    """
    base, quote = parse_pair(name)
    return (
        files.withColumn("base_currency", base)
        .withColumn("quote_currency", quote)
        .where((F.col("base_currency") != "") & (F.col("quote_currency") != ""))
    )


def directory_catalog(spark: SparkSession, directory: str) -> DataFrame:
    """Catalog of a pair-file directory: path, file_name, bytes, base_currency, quote_currency."""
    return pair_catalog(list_parquet_files(spark, directory))
