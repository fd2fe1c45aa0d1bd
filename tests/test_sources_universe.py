"""Pair-file catalog, multi-file load, extract write, universe and classification."""

from __future__ import annotations

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candleframe.operators import classify, profile, setops, universe
from candleframe.plans import extract, universe_load
from candleframe.sources import candles as candle_src
from candleframe.sources import catalog as cat


def _write_pair(directory, name, closes, *, drop=None, start=dt.datetime(2021, 1, 1)):
    n = len(closes)
    cols = {
        "open": pa.array([c - 1 for c in closes], pa.float32()),
        "high": pa.array([c + 1 for c in closes], pa.float32()),
        "low": pa.array([c - 2 for c in closes], pa.float32()),
        "close": pa.array(closes, pa.float32()),
        "volume": pa.array([10.0 * (i + 1) for i in range(n)], pa.float32()),
        "quote_asset_volume": pa.array([1.0] * n, pa.float32()),
        "number_of_trades": pa.array(list(range(n)), pa.int32()),
        "taker_buy_base_asset_volume": pa.array([0.5] * n, pa.float32()),
        "taker_buy_quote_asset_volume": pa.array([0.25] * n, pa.float32()),
        "open_time": pa.array([start + dt.timedelta(hours=i) for i in range(n)], pa.timestamp("us")),
    }
    if drop:
        cols.pop(drop)
    pq.write_table(pa.table(cols), os.path.join(directory, name))


@pytest.fixture
def pair_dir(tmp_path):
    d = tmp_path / "pairs"
    d.mkdir()
    for name, closes in {
        "BTC-USDT.parquet": [100.0, 101.0, 102.5],
        "BTC-EUR.parquet": [90.0, 91.0],
        "ETH-USDT.parquet": [10.0, 10.5],
        "ETH-EUR.parquet": [9.0, 9.5, 9.25],
        "ADA-BUSD.parquet": [1.0, 1.5],
    }.items():
        _write_pair(str(d), name, closes)
    _write_pair(str(d), "README.parquet", [1.0])  # names no pair
    (d / "notes.txt").write_text("not parquet")
    return str(d)


def test_catalog_lists_and_parses_pair_files(spark, pair_dir):
    c = cat.directory_catalog(spark, pair_dir)
    got = sorted((r.file_name, r.base_currency, r.quote_currency) for r in c.collect())
    assert got == [
        ("ADA-BUSD.parquet", "ADA", "BUSD"), ("BTC-EUR.parquet", "BTC", "EUR"), ("BTC-USDT.parquet", "BTC", "USDT"),
        ("ETH-EUR.parquet", "ETH", "EUR"), ("ETH-USDT.parquet", "ETH", "USDT"),
    ]
    sizes = {r.file_name: r.bytes for r in c.collect()}
    assert sizes["BTC-USDT.parquet"] == os.path.getsize(os.path.join(pair_dir, "BTC-USDT.parquet"))
    # The listing reads metadata only.
    plan = cat.list_parquet_files(spark, pair_dir)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1]


def test_load_widens_float_files_and_tags_pairs(spark, pair_dir):
    paths = [os.path.join(pair_dir, n) for n in ("BTC-USDT.parquet", "ADA-BUSD.parquet")]
    df = candle_src.load_pair_files(spark, paths)
    types = dict(df.dtypes)
    assert types["close"] == "double" and types["number_of_trades"] == "bigint" and types["open_time"] == "timestamp_ntz"
    got = sorted((r.base_currency, r.quote_currency, r.close) for r in df.collect())
    assert got == [("ADA", "BUSD", 1.0), ("ADA", "BUSD", 1.5), ("BTC", "USDT", 100.0), ("BTC", "USDT", 101.0), ("BTC", "USDT", 102.5)]


def test_load_rejects_files_missing_a_column(spark, tmp_path):
    d = str(tmp_path)
    _write_pair(d, "XRP-USDT.parquet", [1.0, 2.0], drop="volume")
    with pytest.raises(candle_src.SchemaMismatch):
        candle_src.load_pair_files(spark, [os.path.join(d, "XRP-USDT.parquet")])


def test_load_rejects_one_file_among_good_ones(spark, tmp_path):
    d = str(tmp_path)
    _write_pair(d, "BTC-USDT.parquet", [1.0, 2.0])
    _write_pair(d, "XRP-USDT.parquet", [1.0, 2.0], drop="close")
    with pytest.raises(candle_src.SchemaMismatch, match="XRP-USDT.*close"):
        candle_src.load_pair_files(spark, [os.path.join(d, n) for n in ("BTC-USDT.parquet", "XRP-USDT.parquet")])
    with pytest.raises(candle_src.SchemaMismatch, match="1 of 2"):
        candle_src.load_directory(spark, d)


def test_universe_load_top_bases_common_quotes(spark, pair_dir):
    c = cat.directory_catalog(spark, pair_dir)
    pairs = universe_load.universe_pairs(c, top_n=2)
    assert sorted((r.base_currency, r.quote_currency) for r in pairs.collect()) == [
        ("BTC", "EUR"), ("BTC", "USDT"), ("ETH", "EUR"), ("ETH", "USDT")
    ]
    df = universe_load.load_universe(spark, pair_dir, top_n=2)
    assert df.count() == 10
    classes = {(r.quote_currency, r.classification) for r in df.select("quote_currency", "classification").distinct().collect()}
    assert classes == {("USDT", "stablecoin"), ("EUR", "fiat")}


def test_stock_column_from_file_name_and_extract_write(spark, pair_dir, tmp_path):
    df = candle_src.load_directory(spark, pair_dir)
    stocks = {r.stock for r in df.select("stock").distinct().collect()}
    assert stocks == {"BTC-USDT", "BTC-EUR", "ETH-USDT", "ETH-EUR", "ADA-BUSD", "README"}
    # A filter on the file name prunes files.
    assert df.where(F.col("stock") == "ETH-EUR").count() == 3
    out = str(tmp_path / "extract.parquet")
    summary = extract.run_extract(spark, pair_dir, out, top_n=2)
    written = spark.read.parquet(out)
    assert written.count() == 10
    assert {r.base_currency for r in written.select("base_currency").distinct().collect()} == {"BTC", "ETH"}
    assert summary["min_close"] == 9.0 and summary["max_close"] == 102.5
    with pytest.raises(Exception, match="(?i)already exists"):
        extract.run_extract(spark, pair_dir, out, top_n=2)


def test_classify_by_base_default_and_lists(spark):
    df = spark.createDataFrame([("BTC",), ("USDT",), ("EUR",), ("NEWCOIN",)], "base_currency string")
    got = {r.base_currency: r.classification for r in classify.classify_by_base(df).collect()}
    assert got == {"BTC": "cryptocurrency", "USDT": "stablecoin", "EUR": "fiat_backed", "NEWCOIN": "cryptocurrency"}
    # Crypto listing wins over the other lists.
    got2 = {r.base_currency: r.classification for r in classify.classify_by_base(df, cryptos=("USDT",)).collect()}
    assert got2["USDT"] == "cryptocurrency"


def test_classify_by_quote_default(spark):
    df = spark.createDataFrame([("BUSD",), ("USDT",), ("EUR",), ("BTC",)], "quote_currency string")
    got = {r.quote_currency: r.classification for r in classify.classify_by_quote(df).collect()}
    assert got == {"BUSD": "stablecoin", "USDT": "stablecoin", "EUR": "fiat", "BTC": "cryptocurrency"}


def test_null_profile_counts_nulls_not_nan(spark):
    df = spark.createDataFrame(
        [("A", 1.0, None), (None, float("nan"), 2), ("C", None, None)], "b string, x double, n bigint"
    )
    got = {r.column_name: r.n_null for r in profile.null_profile(df).collect()}
    assert got == {"b": 1, "x": 1, "n": 2}


def test_union_by_name_keeps_columns_apart(spark):
    a = spark.createDataFrame([("A", "Q", 1.0, 2.0)], "base_currency string, quote_currency string, close double, volume double")
    b = spark.createDataFrame([(20.0, 10.0, "Q", "B")], "volume double, close double, quote_currency string, base_currency string")
    got = sorted(tuple(r) for r in setops.union_pairs(a, b).collect())
    assert got == [("A", "Q", 1.0, 2.0), ("B", "Q", 10.0, 20.0)]


def test_universe_operators(spark):
    cat_df = spark.createDataFrame(
        [("BTC", q) for q in ("USDT", "EUR", "BUSD")] + [("ETH", q) for q in ("USDT", "EUR", "BUSD")]
        + [("ADA", q) for q in ("USDT", "EUR")] + [("XRP", "USDT")],
        "base_currency string, quote_currency string",
    )
    counts = universe.quote_count_per_base(cat_df)
    assert sorted(tuple(r) for r in universe.quote_count_histogram(counts).collect()) == [(1, 1), (2, 1), (3, 2)]
    top = universe.top_bases(counts, 3)
    assert [r.base_currency for r in top.collect()] == ["BTC", "ETH", "ADA"]
    assert sorted(r.quote_currency for r in universe.common_quotes(cat_df, top).collect()) == ["EUR", "USDT"]
    complete = universe.complete_bases(cat_df, ["BUSD", "EUR", "USDT"])
    assert sorted(r.base_currency for r in complete.collect()) == ["BTC", "ETH"]
    with pytest.raises(ValueError, match="needs 3 bases"):
        universe.require_bases(complete, ["BTC"], target_quotes=["BUSD", "EUR", "USDT"])
    assert universe.require_bases(complete, ["ETH", "BTC"], minimum=2) == ["ETH", "BTC"]
    with pytest.raises(ValueError, match="not quoted in each of .*: ADA; .*BTC, ETH"):
        universe.require_bases(complete, ["ADA", "BTC"], minimum=2)


def test_file_size_totals(spark, pair_dir):
    files = cat.list_parquet_files(spark, pair_dir)
    sel = spark.createDataFrame([("BTC-USDT.parquet",), ("ETH-EUR.parquet",)], "file_name string")
    r = universe.file_size_totals(files, sel).first()
    size = lambda n: os.path.getsize(os.path.join(pair_dir, n))
    total = sum(size(n) for n in os.listdir(pair_dir) if n.endswith(".parquet"))
    assert r.selected_bytes == size("BTC-USDT.parquet") + size("ETH-EUR.parquet")
    assert r.all_bytes == total
    assert r.pct_selected == pytest.approx(100.0 * r.selected_bytes / total)


def test_universe_file_sizes(spark, pair_dir):
    r = universe_load.universe_file_sizes(spark, pair_dir, top_n=2).first()
    size = lambda n: os.path.getsize(os.path.join(pair_dir, n))
    assert r.selected_bytes == sum(size(f"{b}-{q}.parquet") for b in ("BTC", "ETH") for q in ("USDT", "EUR"))
