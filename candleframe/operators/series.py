"""Per-pair time series: last candle per period, candle returns, daily (log) returns.

Ordering is ``open_time`` then ``seq`` when the frame has it, so ties are deterministic.

Scale note: a pair's candle history can be a large share of all rows (one hot pair), and so
can one hour or second of it (a burst), so the per-candle lag is never a window over such a
pair. It runs inside (pair, slice) partitions (``slices``), and the first candle of each
takes the last close of the slice before from a small per-slice table. Daily series (<= 366 rows per pair-year) use plain per-pair windows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleframe.functions.returns import log_return, simple_return
from candleframe.functions.time import period_start, trade_date, year_of
from candleframe.operators.slices import SLICE_ROWS, cut_slices, micros, renamed_keys, same_keys
from candleframe.schema import PAIR_KEYS, SEQ, TIME, order_columns


def last_in_period(df: DataFrame, period: str, keys=PAIR_KEYS) -> DataFrame:
    """Keep the last candle of each (pair, ``period``) by (open_time, seq).

    ``row_number() = 1`` plans as WindowGroupLimit Partial (before the shuffle) and Final,
    so only one candidate per group and map task crosses the network.
    """
    order = [F.col(c).desc() for c in order_columns(df)]
    w = Window.partitionBy(*keys, period).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


#: Beyond every seq: a time's place value in ``_moment``, and a time before all others.
_PLACE, _NO_TIME = Decimal(2**65), -(2**55)


def _moment(df: DataFrame) -> Column:
    """One never-NULL number that orders like (open_time, seq) with NULLs first.

    Both fit a 38-digit decimal, which hash aggregates keep in place; a struct would sort.
    """
    time = F.coalesce(micros(TIME), F.lit(_NO_TIME))
    if SEQ not in df.columns:
        return time
    if not isinstance(df.schema[SEQ].dataType, T.IntegralType):
        return F.struct(time, SEQ)
    whole = T.DecimalType(38, 0)
    return time.cast(whole) * F.lit(_PLACE) + F.coalesce(F.col(SEQ).cast(whole), F.lit(Decimal(-(2**63) - 1)))


def last_in_period_hashed(df: DataFrame, period: str, keys=PAIR_KEYS) -> DataFrame:
    """Same rows as ``last_in_period``, by a hash aggregate with map-side partials and no sort.

    Every other column is ``max_by`` of one and the same number, the candle's place in
    (open_time, seq). Such aggregates keep or replace their row together, so all columns come
    from one candle, with ties too: equal times are told apart by ``seq``, and of candles
    equal in both one is kept, as ``row_number() = 1`` does. ``classification`` depends on
    the pair, so it is a grouping key; any other string column would bring the sort back.
    """
    group = [*keys, period, *[c for c in ("classification",) if c in df.columns]]
    moment = df.withColumn("_moment", _moment(df))
    return moment.groupBy(*group).agg(
        *[F.max_by(c, "_moment").alias(c) for c in df.columns if c not in group]
    ).select(*df.columns)


def times_are_unique(df: DataFrame, keys=PAIR_KEYS) -> bool:
    """True when no pair has two candles with the same ``open_time``: without ``seq``, all order is certain.

    One aggregation over (pair, open_time) plus an existence probe; it shuffles every key
    once, so run it when the data is new, not on every query.
    """
    dup = df.groupBy(*keys, TIME).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.isEmpty()


def daily_last(df: DataFrame, *, hashed: bool = False, volume_mode: str = "last") -> DataFrame:
    """The last candle of each calendar day per pair, with a ``date`` column.

    Ties are broken by ``seq``. ``hashed=True`` takes the hash aggregate instead of the
    window: the same rows, and no sort if the columns are of fixed width.
    ``volume_mode``: 'last' keeps the last candle's ``volume``, 'sum' gives the day's total
    (NULL volumes are left out; a day without any has NULL).
    """
    d = df.withColumn("date", trade_date(TIME))
    last = last_in_period_hashed(d, "date") if hashed else last_in_period(d, "date")
    if volume_mode == "last":
        return last
    if volume_mode != "sum":
        raise ValueError(f"volume_mode is 'last' or 'sum', not {volume_mode!r}")
    day = [*PAIR_KEYS, "date"]
    totals = d.groupBy(*day).agg(F.sum("volume").alias("_total"))
    same = last["date"].eqNullSafe(totals["date"])
    for k in PAIR_KEYS:
        same = same & last[k].eqNullSafe(totals[k])
    columns = [totals["_total"].alias(c) if c == "volume" else last[c] for c in last.columns]
    return last.join(totals, same, "left").select(*columns)


def lag_in_pair(
    df: DataFrame,
    column: str = "close",
    *,
    out: str = "prev_close",
    slice_rows: int | None = SLICE_ROWS,
    tiebreak: tuple[str, ...] = (),
) -> DataFrame:
    """``out`` = ``column`` of the previous candle of the same pair (NULL for the first one).

    A pair's history is never one window partition once it exceeds ``2 * slice_rows`` candles:
    ``cut_slices`` parts it along (open_time, seq), so a burst within one hour or one
    microsecond is cut like any other stretch. The window runs per (pair, slice), and the
    first candle of a slice takes the last value of the slice before:

    1. counts and quantiles: one aggregate a level over pair and time, merged map-side;
    2. every candle finds its slice by comparing its order with its pair's cuts (an ordinary
       pair has none, and is one slice);
    3. the last value of every slice, aggregated map-side, moves one slice on; it is joined
       on the window's own partitioning, so the candles are shuffled once.

    ``slice_rows=None`` gives the plain per-pair window (same result). ``tiebreak`` names
    further ordering columns.
    """
    keys = list(PAIR_KEYS)
    order = order_columns(df) + list(tiebreak)
    slices = None if slice_rows is None else cut_slices(df, keys, order, slice_rows)
    if slices is None or not slices.levels:
        return df.withColumn(out, F.lag(column).over(Window.partitionBy(*keys).orderBy(*order)))

    sliced = slices.assign(slices.ordered(df))
    order = slices.order_by
    order_key = F.struct(*order) if len(order) > 1 else F.col(order[0])
    ends = sliced.groupBy(*keys, "_slice").agg(F.max_by(column, order_key).alias("_last"))
    carry = ends.select(
        *renamed_keys(keys), F.col("_slice").alias("_of"),
        F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carry"),
    )
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    x = sliced.withColumn("_lag", F.lag(column).over(w)).withColumn("_rn", F.row_number().over(w))
    joined = x.join(carry, same_keys(x, carry, keys) & (x["_slice"] == carry["_of"]), "left")
    return joined.select(
        *[x[c] for c in df.columns if c != out],
        F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag")).alias(out),
    )


def candle_returns(df: DataFrame, *, slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """Simple return between adjacent candles of a pair, whatever the gap between them.

    Adds prev_close, ``return`` (NULL when prev_close is 0) and year; drops each pair's
    first candle (no previous close). See ``lag_in_pair`` for the slices.
    """
    return (
        lag_in_pair(df, slice_rows=slice_rows)
        .withColumn("return", simple_return())
        .withColumn("year", year_of(TIME))
        .where(F.col("prev_close").isNotNull())
    )


def top_of_hour_returns(df: DataFrame, *, slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """``top_of_hour(candle_returns(df))`` without shuffling every candle.

    The previous candle of a minute-0 candle is an earlier minute-0 candle of the same hour
    or the last candle of the nearest earlier non-empty hour. So the lag runs over a small
    frame: the minute-0 candles (and any without open_time), plus one row per non-empty
    pair-hour holding that hour's last candle, taken by an aggregate with map-side partials.
    Those rows sort after a real candle with the same (open_time, seq) and are dropped after
    the lag. For minute candles the frame is about 2/60 of the rows; the sliced lag then runs
    on that frame only.
    """
    keys = list(PAIR_KEYS)
    order = order_columns(df)
    order_key = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last = F.max_by(F.struct(*order, F.col("close").alias("_close")), order_key)
    hour_ends = (
        df.where(F.col(TIME).isNotNull())
        .groupBy(*keys, period_start("hour").alias("_hour"))
        .agg(last.alias("_end"))
        .select(*keys, *[F.col(f"_end.{c}").alias(c) for c in order], F.col("_end._close").alias("close"))
        .withColumn("_pseudo", F.lit(1))
    )
    real = df.where((F.minute(TIME) == 0) | F.col(TIME).isNull()).withColumn("_pseudo", F.lit(0))
    frame = real.unionByName(hour_ends, allowMissingColumns=True)
    lagged = lag_in_pair(frame, slice_rows=slice_rows, tiebreak=("_pseudo",))
    return (
        lagged.where((F.col("_pseudo") == 0) & F.col(TIME).isNotNull())
        .drop("_pseudo")
        .withColumn("return", simple_return())
        .withColumn("year", year_of(TIME))
        .where(F.col("prev_close").isNotNull())
    )


def pairs_with_returns(df: DataFrame) -> DataFrame:
    """(base, quote) that have at least one candle return, without a lag.

    A candle has a return when the candle before it has a close, so a pair has one exactly
    when some non-NULL close is not on the pair's last candle: count(close) minus one if the
    last candle's close is non-NULL is at least 1. One aggregate with map-side partials.
    """
    order = order_columns(df)
    order_key = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last_close = F.max_by("close", order_key)
    return (
        df.groupBy(*PAIR_KEYS)
        .agg(F.count("close").alias("_n"), last_close.alias("_last"))
        .where(F.col("_n") - F.when(F.col("_last").isNotNull(), 1).otherwise(0) >= 1)
        .select(*PAIR_KEYS)
    )


def top_of_hour(df: DataFrame) -> DataFrame:
    """Keep candles opening at minute 0 (applied after the lag, so returns span one candle)."""
    return df.where(F.minute(TIME) == 0)


def _with_prev_day(daily: DataFrame) -> DataFrame:
    w = Window.partitionBy(*PAIR_KEYS).orderBy("date")
    return daily.withColumn("prev_close", F.lag("close").over(w))


def log_returns_of_daily(daily: DataFrame) -> DataFrame:
    """``daily_log_returns`` from an already computed last-of-day table (``daily_last``)."""
    return (
        _with_prev_day(daily)
        .withColumn("log_return", log_return())
        .where(F.col("log_return").isNotNull())
        .withColumn("year", year_of("date"))
    )


def returns_of_daily(daily: DataFrame) -> DataFrame:
    """``daily_returns`` from an already computed last-of-day table (``daily_last``)."""
    return _with_prev_day(daily).withColumn("return", simple_return()).where(F.col("return").isNotNull())


def daily_log_returns(df: DataFrame, *, hashed: bool = False) -> DataFrame:
    """ln(close / previous day's close) per pair on last-of-day candles; first day dropped.

    Days without candles are skipped, so a return may span several calendar days.
    """
    return log_returns_of_daily(daily_last(df, hashed=hashed))


def daily_returns(df: DataFrame, *, hashed: bool = False, volume_mode: str = "last") -> DataFrame:
    """Simple daily return on last-of-day candles; rows with a NULL return are dropped.

    ``volume`` is that of the day's last candle, or with ``volume_mode='sum'`` the day's total.
    """
    return returns_of_daily(daily_last(df, hashed=hashed, volume_mode=volume_mode))
