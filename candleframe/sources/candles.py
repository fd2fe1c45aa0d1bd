"""Load pair files into one candle DataFrame.

One multi-path Parquet scan with a declared schema replaces a read per file plus a fold of
unions: a single FileSourceScan whose splits are planned across all files, with the pair
columns taken from the hidden ``_metadata.file_name`` column (a filter on it prunes files).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candleframe.schema import CANDLE_COLUMNS, CANDLE_SCHEMA
from candleframe.sources.catalog import list_parquet_files, parse_pair


class SchemaMismatch(ValueError):
    """A pair file lacks a declared candle column (it would silently read as NULL)."""


def _gaps(required: tuple[str, ...]):
    """A mapInArrow function: of (path) rows, the files that lack columns, or that Python cannot open.

    It carries all it needs, so workers need not import this package.
    """

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def names(path):
            scheme, colon, rest = path.partition(":")
            if not colon or "/" in scheme:
                store, at = pafs.LocalFileSystem(), path
            elif scheme == "file":
                store, at = pafs.LocalFileSystem(), "/" + rest.lstrip("/")
            else:
                authority, _, at = rest.removeprefix("//").partition("/")
                try:
                    store, root = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError, OSError):
                    return None  # a store that only Spark reads
                at = f"{root.rstrip('/')}/{at}" if root.strip("/") else f"/{at}" if scheme == "hdfs" else f"{authority}/{at}"
            with store.open_input_file(at) as f:
                return set(pq.ParquetFile(f).schema_arrow.names)

        for b in batches:
            bad = []
            for path in b.column(0).to_pylist():
                have = names(path)
                missing = None if have is None else [c for c in required if c not in have]
                if missing is None or missing:
                    bad.append((path, missing))
            if bad:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in bad], pa.string()), pa.array([m for _, m in bad], pa.list_(pa.string()))], ["path", "missing"])

    return run


def check_columns(files: DataFrame, required=CANDLE_COLUMNS) -> None:
    """Fail early if any one file of ``files`` (path) misses a declared column (it would read as NULL).

    One job: executors read the footers, each file's own (merged footers would let one
    file's columns hide another's gap), and only faulty files come back. Files in a store
    that Python cannot open are read by Spark, one by one.
    """
    spark, seen = files.sparkSession, Observation()
    listed = files.select("path").observe(seen, F.count(F.lit(1)).alias("n"))
    found = listed.mapInArrow(_gaps(tuple(required)), "path string, missing array<string>").collect()
    bad = []
    for r in found:
        missing = r.missing
        if missing is None:
            have = set(spark.read.parquet(r.path).columns)
            missing = [c for c in required if c not in have]
        if missing:
            bad.append((r.path, missing))
    if bad:
        told = "; ".join(f"{path}: {', '.join(missing)}" for path, missing in sorted(bad)[:5])
        raise SchemaMismatch(f"{len(bad)} of {seen.get['n']} pair files lack columns ({told})")


#: Partitions at most that a given list of paths is dealt over.
FOOTER_TASKS = 256


def load_pair_files(
    spark: SparkSession, paths: Iterable[str], *, check: bool = True
) -> DataFrame:
    """Candles of the given ``BASE-QUOTE.parquet`` files plus base_currency / quote_currency."""
    paths = list(paths)
    if not paths:
        raise ValueError("no pair files to load")
    if check:
        check_columns(spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), FOOTER_TASKS)))
    df = spark.read.schema(CANDLE_SCHEMA).parquet(*paths)
    base, quote = parse_pair(F.col("_metadata.file_name"))
    return df.select(*CANDLE_COLUMNS, base.alias("base_currency"), quote.alias("quote_currency"))


def load_directory(spark: SparkSession, directory: str, *, check: bool = True) -> DataFrame:
    """Every ``*.parquet`` pair file of a directory (the extract script's input), with ``stock``."""
    if check:
        check_columns(list_parquet_files(spark, directory))
    df = spark.read.schema(CANDLE_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(directory)
    return with_stock_column(df, F.col("_metadata.file_name"))


def with_stock_column(df: DataFrame, path=None) -> DataFrame:
    """``stock`` = file stem ``BASE-QUOTE`` of ``path`` (default: the row's source file)."""
    path = F.col("_metadata.file_name") if path is None else path
    path = F.col(path) if isinstance(path, str) else path
    return df.withColumn("stock", F.regexp_extract(path, r"([^/]+)\.parquet", 1))


def split_stock(df: DataFrame, stock: str = "stock") -> DataFrame:
    """base_currency / quote_currency from ``BASE-QUOTE`` (ANSI-safe ``split_part``)."""
    return df.withColumn("base_currency", F.split_part(F.col(stock), F.lit("-"), F.lit(1))).withColumn(
        "quote_currency", F.split_part(F.col(stock), F.lit("-"), F.lit(2))
    )
