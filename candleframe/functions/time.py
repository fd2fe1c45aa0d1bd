"""Time fields of ``open_time`` (timestamp_ntz: independent of the session time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def year_of(ts="open_time") -> Column:
    """Calendar year as bigint (stable type for joins and comparisons)."""
    return F.year(_c(ts)).cast("bigint")


def hour_of_day(ts="open_time") -> Column:
    return F.hour(_c(ts)).cast("bigint")


def trade_date(ts="open_time") -> Column:
    return F.to_date(_c(ts))


def period_start(unit: str, ts="open_time") -> Column:
    """Start of the ``unit`` containing ``ts``, as timestamp_ntz, on the wall clock.

    'hour', 'day', 'month' and 'year' are rebuilt from the value's own fields, so they do not
    depend on the session time zone (``date_trunc`` goes through a session-zone timestamp,
    where a DST gap moves wall-clock times into the next hour). Other units use
    ``date_trunc``.
    """
    t = _c(ts)
    zero = F.lit(0)
    one = F.lit(1)
    fields = {
        "hour": (F.year(t), F.month(t), F.dayofmonth(t), F.hour(t)),
        "day": (F.year(t), F.month(t), F.dayofmonth(t), zero),
        "month": (F.year(t), F.month(t), one, zero),
        "year": (F.year(t), one, one, zero),
    }
    if unit in fields:
        y, m, d, h = fields[unit]
        return F.make_timestamp_ntz(y, m, d, h, zero, zero)
    return F.date_trunc(unit, t).cast("timestamp_ntz")
