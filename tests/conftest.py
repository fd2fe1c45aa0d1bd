from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from candleframe.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

CANDLE_DDL = (
    "base_currency string, quote_currency string, open_time timestamp_ntz, seq bigint, "
    "close double, volume double"
)


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="candleframe-tests")
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


@pytest.fixture
def candles(spark):
    """Build a candle frame from (base, quote, 'YYYY-MM-DD HH:MM', seq, close, volume) rows."""

    def make(rows):
        return spark.createDataFrame(
            [(b, q, ts(t), s, c, v) for b, q, t, s, c, v in rows], CANDLE_DDL
        )

    return make
