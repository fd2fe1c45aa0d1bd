"""Candle views over the driver's TPC-H-ish tables (stand-ins for the exchange pair files).

Every view is a lazy DataFrame over whole tables, so each query's work grows with them.
The same definitions are written in SQL in ``candleframe.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleframe.functions.time import period_start
from candleframe.operators.classify import classify_by_quote

# Fixture quote classes for candles_daily (o_orderstatus plays the quote).
DAILY_QUOTE_CLASSES = {"stablecoin": ("F", "O"), "fiat": ("P",)}


# Declared schemas (only the columns the views use): no schema inference, no footer reads on
# the driver, and the scan reads just these columns.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def candles_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candle per order: base = market segment, quote = order status, daily open_time.

    Line items are aggregated per order *before* the join (map-side partial aggregation,
    and the aggregate is already hash-partitioned on the order key for the join).
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("_qty"),
            F.sum("l_extendedprice").alias("_price"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    df = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .join(customer, orders.o_custkey == customer.c_custkey)
        .select(
            F.col("c_mktsegment").alias("base_currency"),
            F.col("o_orderstatus").alias("quote_currency"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("open_time"),
            F.col("o_orderkey").alias("seq"),
            F.col("o_totalprice").alias("close"),
            F.coalesce("_qty", F.lit(0.0)).alias("volume"),
            F.coalesce("_price", F.lit(0.0)).alias("quote_asset_volume"),
            F.coalesce("_n", F.lit(0)).cast("bigint").alias("number_of_trades"),
        )
    )
    return classify_by_quote(df, DAILY_QUOTE_CLASSES)


def candles_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular tick candles from ``events``: base = event type, quote = 'U' || user_id % 4."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("base_currency"),
        F.concat(F.lit("U"), (F.col("user_id") % 4).cast("string")).alias("quote_currency"),
        F.col("ts").cast("timestamp_ntz").alias("open_time"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("close"),
        F.expr("try_cast(regexp_extract(props, '([0-9]+)', 1) AS double)").alias("volume"),
    )


def candles_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles from the ticks: close of the last tick, summed volume, seq = 0.

    One aggregation per (pair, hour) with map-side partials (sorted ones: ``max_by`` orders by
    the struct (open_time, seq)), so even a very busy hour never sits in one task.
    """
    ticks = candles_ticks(spark, sf_dir).withColumn("_hour", period_start("hour"))
    return ticks.groupBy("base_currency", "quote_currency", "_hour").agg(
        F.max_by("close", F.struct("open_time", "seq")).alias("close"),
        F.sum("volume").alias("volume"),
    ).select(
        "base_currency",
        "quote_currency",
        F.col("_hour").alias("open_time"),
        F.lit(0).cast("bigint").alias("seq"),
        "close",
        "volume",
    )


def candles_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candle per line item: base = the supplier's nation, quote = 'Q' || suppkey % 4.

    Nations have suppliers for some of the quotes only, so that many pairs are empty.
    """
    items = read_table(spark, sf_dir, "lineitem")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    seller = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    return items.join(seller, items.l_suppkey == seller.s_suppkey).select(
        F.col("n_name").alias("base_currency"),
        F.concat(F.lit("Q"), (F.col("s_suppkey") % 4).cast("string")).alias("quote_currency"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("open_time"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10_000_000 + F.col("l_partkey")).cast("bigint").alias("seq"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
    )


def pair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair file names ``BASE-QUOTE.parquet``: base = nation, quote = 'Q' || suppkey % 4."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(
            F.concat(
                F.col("n_name"),
                F.lit("-Q"),
                (F.col("s_suppkey") % 4).cast("string"),
                F.lit(".parquet"),
            ).alias("file_name")
        )
        .distinct()
    )
