"""Sources and sinks: pair-file catalog, multi-file candle loader, fixture views, Parquet sink."""

from candleframe.sources.candles import (
    SchemaMismatch,
    load_directory,
    load_pair_files,
    split_stock,
    with_stock_column,
)
from candleframe.sources.catalog import (
    directory_catalog,
    list_parquet_files,
    pair_catalog,
    parse_pair,
)
from candleframe.sources.sinks import deal_by_size, write_by_size, write_parquet

__all__ = [
    "SchemaMismatch",
    "deal_by_size",
    "directory_catalog",
    "list_parquet_files",
    "load_directory",
    "load_pair_files",
    "pair_catalog",
    "parse_pair",
    "split_stock",
    "with_stock_column",
    "write_by_size",
    "write_parquet",
]
