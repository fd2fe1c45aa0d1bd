"""Candle data model: the declared schema, key columns and fixed parameter values."""

from __future__ import annotations

import math

from pyspark.sql import types as T

# One row = one trading period of one base-quote pair. Prices and volumes are declared
# double and the trade count bigint: float/int files widen to these on read, and
# float32 arithmetic (close - prev_close) would otherwise lose precision.
CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("quote_asset_volume", T.DoubleType()),
        T.StructField("number_of_trades", T.LongType()),
        T.StructField("taker_buy_base_asset_volume", T.DoubleType()),
        T.StructField("taker_buy_quote_asset_volume", T.DoubleType()),
        T.StructField("open_time", T.TimestampNTZType()),
    ]
)

CANDLE_COLUMNS = tuple(f.name for f in CANDLE_SCHEMA.fields)

BASE = "base_currency"
QUOTE = "quote_currency"
PAIR_KEYS = (BASE, QUOTE)
TIME = "open_time"
# Optional row id used to break ties on open_time; used when the frame has it.
SEQ = "seq"

# --- Fixed values: these must equal the reference's for the same results. ---------------
# Quote classification of the candle universe (notebook rule); anything else is
# "cryptocurrency".
QUOTE_CLASSES = {"stablecoin": ("BUSD", "USDT"), "fiat": ("EUR",)}
# Base classification of the extract (script rule). The script also lists ~260 crypto
# bases, but listed and unlisted bases both end up "cryptocurrency" and the lists do not
# overlap, so only these two lists decide an outcome.
BASE_STABLECOINS = ("USDT", "USDC", "BUSD", "TUSD", "DAI", "PAX", "BIDR", "IDRT")
BASE_FIATS = ("EUR", "GBP", "AUD", "TRY", "BRL", "RUB", "NGN", "UAH")
DEFAULT_CLASS = "cryptocurrency"
# Analysis parameters.
TOP_BASES_NOTEBOOK = 10
TOP_BASES_EXTRACT = 75
YEAR_QUOTES = ("USDT", "BUSD", "EUR")
CORR_QUOTES = ("BUSD", "EUR", "USDT")
CORR_BASES = ("ADA", "ETH", "BTC")
CORR_YEARS = tuple(range(2017, 2023))
MIN_COMPLETE_BASES = 3
ROLLING_WINDOW_ROWS = 30
MIN_ROLLING_OBS = 10
ANNUALIZATION = math.sqrt(365)
SAMPLE_SEED = 42
SAMPLE_SIZE = 3
HOUR_CORR_CLIP = 0.5
PANEL_BASES = 10
PANEL_YEARS = 6
# ------------------------------------------------------------------------------------------


def order_columns(df) -> list[str]:
    """Time order of a pair's candles: open_time, then the tie-breaking row id if present."""
    return [c for c in (TIME, SEQ) if c in df.columns]
