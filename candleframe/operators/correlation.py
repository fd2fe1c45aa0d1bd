"""Return correlations: key-by-key matrices per (group, year) and return vs hour of day.

Matrices are long form: (group, year, key_a, key_b, corr, n_obs), one row per cell of a
dense grid over the requested groups x years x keys x keys. ``n_obs`` is the number of
timestamps where both keys have a return (0 = empty cell); ``corr`` is NULL when undefined.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candleframe.functions.stats import clip, guarded_corr, pair_count
from candleframe.functions.time import hour_of_day
from candleframe.operators.activity import pair_label
from candleframe.operators.series import top_of_hour
from candleframe.schema import (
    BASE,
    CORR_BASES,
    CORR_QUOTES,
    CORR_YEARS,
    HOUR_CORR_CLIP,
    QUOTE,
    TIME,
)


#: Keys of a block: statistics are aggregated for the BLOCK x BLOCK pairs of two blocks at a time.
BLOCK = 3


def pairwise_correlation(
    df: DataFrame,
    *,
    group: str,
    key: str,
    groups: Sequence[str],
    keys: Sequence[str],
    years: Sequence[int] | None,
    value: str = "return",
    time: str = TIME,
) -> DataFrame:
    """Pearson correlation of ``value`` between every two ``keys`` per (group, year).

    1. Keys are dealt into blocks. One aggregation to (group, year, time, block) cells, one
       column per place in the block: the mean of the values in the cell (duplicates
       averaged, NULLs ignored).
    2. A timestamp's blocks are gathered (at most one row each) and every two of them give one
       row; one aggregation per (group, year, two blocks) holds covariance/stddev partials
       over the timestamps where both keys are present (pairwise-complete).
    3. A (group, year) grid is exploded to one row per key pair and left-joined to it.
    The plan has one size for any number of keys, and rows are emitted per pair of blocks of
    a timestamp, never per pair of candles. Keys of one block need no gathering.
    ``years=None`` uses the years present in the selected rows (a short collected list).
    """
    keys = list(dict.fromkeys(keys))
    groups = list(dict.fromkeys(groups))
    wanted = df.where(F.col(group).isin(groups) & F.col(key).isin(keys))
    if years is None:
        years = sorted(r.year for r in wanted.select("year").distinct().collect() if r.year is not None)
    years = [int(y) for y in dict.fromkeys(years)]
    names = F.lit(keys).cast("array<string>")
    number = F.array_position(names, F.col(key).cast("string")) - 1
    places = range(BLOCK)

    cells = (
        wanted.where(F.col("year").isin(years))
        .select(group, "year", time, F.col(value).alias("_v"), F.floor(number / BLOCK).cast("int").alias("_block"),
                F.pmod(number, F.lit(BLOCK)).cast("int").alias("_place"))
        .groupBy(group, "year", time, "_block")
        .agg(*[F.avg(F.when(F.col("_place") == p, F.col("_v"))).alias(f"_x{p}") for p in places])
    )
    if len(keys) > BLOCK:
        block = F.struct(F.col("_block").alias("block"), F.array(*[f"_x{p}" for p in places]).alias("x"))
        gathered = cells.groupBy(group, "year", time).agg(F.sort_array(F.collect_list(block)).alias("_blocks"))
        two = F.flatten(F.transform("_blocks", lambda a, i: F.transform(
            F.slice("_blocks", i + 1, F.size("_blocks")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
        each = gathered.select(group, "year", F.explode(two).alias("_two")).select(
            group, "year", F.col("_two.a.block").alias("_a"), F.col("_two.b.block").alias("_b"),
            *[F.col("_two.a.x")[p].alias(f"_x{p}") for p in places], *[F.col("_two.b.x")[p].alias(f"_y{p}") for p in places])
    else:
        each = cells.select(group, "year", F.lit(0).alias("_a"), F.lit(0).alias("_b"),
                            *[f"_x{p}" for p in places], *[F.col(f"_x{p}").alias(f"_y{p}") for p in places])
    stats = each.groupBy(group, "year", "_a", "_b").agg(
        *[guarded_corr(f"_x{i}", f"_y{j}").alias(f"_c{i}_{j}") for i, j in product(places, places)],
        *[pair_count(f"_x{i}", f"_y{j}").alias(f"_n{i}_{j}") for i, j in product(places, places)],
    )
    found = stats.select(group, "year", F.inline(F.array(*[
        F.struct((F.col("_a") * BLOCK + i).alias("_i"), (F.col("_b") * BLOCK + j).alias("_j"),
                 F.col(f"_c{i}_{j}").alias("corr"), F.col(f"_n{i}_{j}").alias("n_obs"))
        for i, j in product(places, places)
    ]))).where(F.col("_i") <= F.col("_j"))

    grid_schema = T.StructType(
        [T.StructField(group, T.StringType(), False), T.StructField("year", T.LongType(), False)]
    )
    every = F.sequence(F.lit(0), F.lit(len(keys) - 1)) if keys else F.array().cast("array<int>")
    grid = (
        df.sparkSession.createDataFrame([(g, y) for g in groups for y in years], grid_schema)
        .withColumn("_ka", F.explode(every)).withColumn("_kb", F.explode(every))
        .withColumns({"_i": F.least("_ka", "_kb"), "_j": F.greatest("_ka", "_kb")})
    )
    return grid.join(found, on=[group, "year", "_i", "_j"], how="left").select(
        group,
        "year",
        F.get(names, "_ka").alias(f"{key.split('_')[0]}_a"),
        F.get(names, "_kb").alias(f"{key.split('_')[0]}_b"),
        "corr",
        F.coalesce("n_obs", F.lit(0)).cast("bigint").alias("n_obs"),
    )


def corr_across_quotes(
    returns: DataFrame,
    *,
    quotes: Sequence[str] = CORR_QUOTES,
    bases: Sequence[str] = CORR_BASES,
    years: Sequence[int] | None = CORR_YEARS,
) -> DataFrame:
    """Per base and year: correlation of top-of-hour candle returns between quotes."""
    return pairwise_correlation(
        top_of_hour(returns), group=BASE, key=QUOTE, groups=bases, keys=quotes, years=years
    )


def corr_across_bases(
    returns: DataFrame,
    *,
    quotes: Sequence[str] = CORR_QUOTES,
    bases: Sequence[str] = CORR_BASES,
    years: Sequence[int] | None = CORR_YEARS,
) -> DataFrame:
    """Per quote and year: correlation of top-of-hour candle returns between bases."""
    return pairwise_correlation(
        top_of_hour(returns), group=QUOTE, key=BASE, groups=quotes, keys=bases, years=years
    )


def hour_moments(returns: DataFrame) -> DataFrame:
    """(pair, hour_of_day, n_h, mean_h, var_h) of the non-NULL returns: one aggregate."""
    return (
        returns.where(F.col("return").isNotNull())
        .select(pair_label().alias("pair"), hour_of_day(TIME).alias("hour_of_day"), "return")
        .groupBy("pair", "hour_of_day")
        .agg(
            F.count(F.lit(1)).alias("n_h"),
            F.avg("return").alias("mean_h"),
            F.var_pop("return").alias("var_h"),
        )
    )


def hour_correlation_from_moments(per_hour: DataFrame, *, clip_at: float = HOUR_CORR_CLIP) -> DataFrame:
    """corr(1[hour = h], return) per (pair, hour) from the ``hour_moments`` table.

    An indicator's correlation is the distance of its group's mean from the overall mean in
    standard deviations, times the square root of its odds. The pair's mean and variance are
    pooled from its hours (<= 24 rows per pair) without subtracting squares.
    """
    w = Window.partitionBy("pair")
    pooled = per_hour.withColumn("_n", F.sum("n_h").over(w)).withColumn(
        "_mean", F.sum(F.col("n_h") * F.col("mean_h")).over(w) / F.col("_n")
    )
    gap = F.col("mean_h") - F.col("_mean")
    pooled = pooled.withColumn("_var", F.sum(F.col("n_h") * (F.col("var_h") + gap * gap)).over(w) / F.col("_n"))
    odds = F.try_divide(F.col("n_h"), F.col("_n") - F.col("n_h"))
    s = pooled.select(
        "pair", "hour_of_day", F.when(F.col("_var") > 0, gap * F.sqrt(odds) / F.sqrt("_var")).alias("corr")
    )
    return s.select("pair", "hour_of_day", "corr", clip("corr", -clip_at, clip_at).alias("corr_clipped"))


def hour_return_correlation(returns: DataFrame, *, clip_at: float = HOUR_CORR_CLIP) -> DataFrame:
    """corr(1[hour = h], return) per pair and hour, from one aggregate (no row repeated per hour).

    NULL where the pair has one hour only or constant returns. Returns that are NULL (zero
    previous close) are left out.
    """
    return hour_correlation_from_moments(hour_moments(returns), clip_at=clip_at)
