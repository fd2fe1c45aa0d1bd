"""Rank statistics: Spearman correlation of volume with return per pair, with p-value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleframe.functions.stats import student_t_two_sided_p
from candleframe.operators.slices import cut_slices, renamed_keys, same_keys
from candleframe.schema import PAIR_KEYS
from candleframe.session import checked_broadcast, checkpointed

#: Distinct rows that one task ranks, about; at most twice as many.
RANK_ROWS = 100_000


def average_ranks(
    rows: DataFrame, column: str, out: str, *, keys: Sequence[str], weight: str, slice_rows: int = RANK_ROWS
) -> DataFrame:
    """``rows`` with ``out``: the 1-based rank of ``column`` within ``keys``, ties get the mean of their places.

    A row stands for ``weight`` equal ones. A group of more than ``2 * slice_rows`` rows is cut
    into ranges of values, which are ranked on their own and shifted by what lies before
    them. A value that fills more than a range has it for itself: its rank follows from
    its count alone, so its rows are dealt over tasks by their content.
    NULLs come first; give them no weight. ``rows`` is read several times: stage it.
    """
    keys = list(keys)
    slices = cut_slices(rows, keys, [column], slice_rows, part_ties=False)
    part, before, alone = keys, F.lit(0), F.lit(None).cast("bigint")
    placed = rows
    if slices.levels:
        sliced = slices.assign(rows)
        sizes = sliced.groupBy(*keys, "_slice").agg(
            F.sum(weight).alias("_n"), F.min(column).alias("_low"), F.max(column).alias("_high"), F.count(column).alias("_known"),
            F.count(F.lit(1)).alias("_rows"))
        up_to = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        one = (F.col("_low") == F.col("_high")) & (F.col("_known") == F.col("_rows"))
        sizes = checkpointed(sizes.select(
            *renamed_keys(keys), F.col("_slice").alias("_of"),
            F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"), F.when(one, F.col("_n")).alias("_alone")))
        placed = sliced.join(checked_broadcast(sizes), same_keys(sliced, sizes, keys) & (sliced["_slice"] == sizes["_of"])).select(
            *[sliced[c] for c in rows.columns], "_slice", "_before", "_alone")
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.withColumn("_salt", F.when(F.col("_alone").isNull(), 0).otherwise(F.pmod(F.xxhash64(*rows.columns), F.lit(salts))))
        part, before, alone = [*keys, "_slice", "_salt"], F.col("_before"), F.col("_alone")
    # The default frame reaches the current row's peers.
    reached = F.sum(weight).over(Window.partitionBy(*part).orderBy(column))
    ties = F.sum(weight).over(Window.partitionBy(*part, column))
    rank = before + F.when(alone.isNotNull(), (alone + 1) / 2).otherwise(reached - (ties - 1) / 2)
    return placed.withColumn(out, rank).select(*[c for c in rows.columns if c != out], out)


def spearman(
    df: DataFrame,
    x: str = "volume",
    y: str = "return",
    *,
    keys: Sequence[str] = PAIR_KEYS,
    slice_rows: int = RANK_ROWS,
) -> DataFrame:
    """(keys..., n, rho, p_value): Spearman rank correlation of ``x`` and ``y`` per group.

    Only rows where both values are non-NULL are ranked (a SciPy call on NULLs would return
    NaN); ``n`` counts them. Every group of the input is kept: one without such rows has
    n = 0 and NULL statistics. Ties get average ranks. rho is the Pearson correlation of the
    ranks (NULL for a constant column); p_value is the two-sided t-test p with n-2 degrees
    of freedom (NULL for n < 3).

    Equal (x, y) of a group are counted map-side into one weighted row; those rows are
    checkpointed, so ``df`` is computed once. Groups may be of any size (``average_ranks``). Ranks are
    centred on their known mean (n + 1) / 2 before they are multiplied.
    """
    keys = list(keys)
    valid = F.col(x).isNotNull() & F.col(y).isNotNull()
    rows = checkpointed(
        df.select(*keys, F.when(valid, F.col(x)).alias("_x"), F.when(valid, F.col(y)).alias("_y"))
        .groupBy(*keys, "_x", "_y").agg(F.count("_x").alias("_w")))
    ranked = average_ranks(rows, "_x", "_rx", keys=keys, weight="_w", slice_rows=slice_rows)
    ranked = average_ranks(ranked, "_y", "_ry", keys=keys, weight="_w", slice_rows=slice_rows)
    totals = rows.groupBy(*keys).agg(F.sum("_w").alias("n"))
    totals = totals.select(*renamed_keys(keys), "n")
    centred = ranked.join(totals, same_keys(ranked, totals, keys))
    middle = (F.col("n") + 1) / 2
    dx, dy, w = F.col("_rx") - middle, F.col("_ry") - middle, F.col("_w")
    stats = centred.groupBy(*keys).agg(
        F.sum("_w").alias("n"), F.sum(w * dx * dy).alias("_xy"), F.sum(w * dx * dx).alias("_xx"), F.sum(w * dy * dy).alias("_yy"))
    rho = F.try_divide(F.col("_xy"), F.sqrt("_xx") * F.sqrt("_yy"))
    return stats.select(*keys, "n", rho.alias("rho")).withColumn("p_value", student_t_two_sided_p("rho", "n"))
