"""Return expressions that never raise under ANSI mode.

Spark 4 runs with ANSI on: ``x / 0.0`` raises DIVIDE_BY_ZERO. Older non-ANSI Spark gave
NULL there, which is what a zero price must produce, so every division is ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def simple_return(close="close", prev_close="prev_close") -> Column:
    """(close - prev) / prev; NULL when prev is NULL or 0."""
    close, prev_close = _c(close), _c(prev_close)
    return F.try_divide(close - prev_close, prev_close)


def log_return(close="close", prev_close="prev_close") -> Column:
    """ln(close / prev); NULL when prev is NULL or 0, or when the ratio is not positive."""
    ratio = F.try_divide(_c(close), _c(prev_close))
    return F.when(ratio > 0, F.ln(ratio))
