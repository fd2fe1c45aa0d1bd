"""Column expressions: NULL-safe returns, guarded statistics, time fields.

Everything here is a plain ``pyspark.sql.Column`` built from JVM-side functions, so it
stays inside whole-stage codegen; nothing is a Python UDF.
"""

from candleframe.functions.returns import log_return, simple_return
from candleframe.functions.stats import (
    clip,
    guarded_corr,
    pair_count,
    student_t_two_sided_p,
)
from candleframe.functions.time import hour_of_day, period_start, trade_date, year_of

__all__ = [
    "clip",
    "guarded_corr",
    "hour_of_day",
    "log_return",
    "pair_count",
    "period_start",
    "simple_return",
    "student_t_two_sided_p",
    "trade_date",
    "year_of",
]
