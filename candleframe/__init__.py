"""candleframe: candle (OHLCV) analytics as distributed Spark DataFrame operators."""

__version__ = "0.1.0"
