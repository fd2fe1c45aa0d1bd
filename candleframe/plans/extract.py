"""Closing-price extract: classify pairs by base, keep the top bases, write, summarize.

    python -m candleframe.plans.extract PAIR_DIR OUT_PATH [--top-n 75]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candleframe.operators.classify import classify_by_base
from candleframe.operators.profile import closing_price_statistics
from candleframe.operators.universe import quote_count_per_base, top_bases
from candleframe.schema import BASE, TOP_BASES_EXTRACT
from candleframe.sources.candles import load_directory, split_stock
from candleframe.sources.catalog import directory_catalog
from candleframe.sources.sinks import FILE_ROWS, deal_by_size, write_parquet

EXTRACT_COLUMNS = ("stock", "base_currency", "quote_currency", "open_time", "close", "classification")


def closing_price_extract(
    candles: DataFrame,
    catalog: DataFrame,
    *,
    top_n: int = TOP_BASES_EXTRACT,
    stablecoins=None,
    fiats=None,
) -> DataFrame:
    """(stock, base, quote, open_time, close, classification) for the top-``top_n`` bases.

    ``candles`` carries ``stock`` = BASE-QUOTE; ``catalog`` lists the pairs (one row per
    file) from which the top bases by quote count are taken. The class dimension and the
    top-base list are both bounded by parameters (list lengths, ``top_n``), so both joins
    broadcast them.
    """
    kw = {}
    if stablecoins is not None:
        kw["stablecoins"] = stablecoins
    if fiats is not None:
        kw["fiats"] = fiats
    top = top_bases(quote_count_per_base(catalog), top_n).select(BASE)
    df = split_stock(candles)
    return (
        classify_by_base(df, **kw)
        .join(F.broadcast(top), on=BASE, how="left_semi")
        .select(*EXTRACT_COLUMNS)
    )


def run_extract(
    spark: SparkSession, directory: str, out_path: str, *, top_n: int = TOP_BASES_EXTRACT, file_rows: int = FILE_ROWS
) -> dict:
    """Whole extract job over a pair-file directory: write the extract, return its summary row.

    Candles are read once: the summary's four statistics are observed while the rows are
    written, and nothing is cached. Files of about ``file_rows`` rows: a first pass counts
    rows per base, which is part of the file name, so it reads no column.
    """
    extract = closing_price_extract(load_directory(spark, directory), directory_catalog(spark, directory), top_n=top_n)
    seen = Observation()
    write_parquet(deal_by_size(extract, (BASE,), file_rows=file_rows).observe(seen, *closing_price_statistics()), out_path)
    return dict(seen.get)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Closing-price extract of the top bases")
    ap.add_argument("pair_dir")
    ap.add_argument("out_path")
    ap.add_argument("--top-n", type=int, default=TOP_BASES_EXTRACT)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    summary = run_extract(spark, args.pair_dir, args.out_path, top_n=args.top_n)
    for name, value in summary.items():
        print(f"{name}\t{value}")


if __name__ == "__main__":
    main()
