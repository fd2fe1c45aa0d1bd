"""Gapless places in a total order, without ranking a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleframe.llm.common import stage

#: Runs up to which their table is broadcast, a few MB; it is joined by shuffle beyond.
MOST_RUNS = 100_000


def placed(df: DataFrame, group: str, order: list[str], name: str, weight: str | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``_at``, the place 0, 1, ... in the order within its ``group``, and ``_n``, the group's size.

    Also returns the largest group's size, 0 without rows. With ``weight``, ``_before`` is
    the weight of all rows of the group that come before.

    NULLs are a group, and come first in the order. One range shuffle: a hot group lies over
    many sorted partitions, rows that tie in all of ``order`` are parted by their place in
    ``df``, and a small table of (partition, group) runs gives what lies before each of them.
    ``df`` is read twice (bounds, then rows): stage it. Its columns start with no ``_``.
    """
    by = [F.col(c).asc_nulls_first() for c in [group, *order, "_salt"]]
    ranged = stage(
        df.withColumn("_salt", F.monotonically_increasing_id())
        .repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
        .withColumn("_row", F.monotonically_increasing_id()),  # partition << 33 | place in it
        name,
    ).withColumn("_part", F.shiftright("_row", 33))
    load = F.lit(0) if weight is None else F.col(weight)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(
        ranged.groupBy("_part", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"), F.sum(load).alias("_load"))
        .select(F.col("_part").alias("_p"), F.col(group).alias("_g"),
                (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                F.coalesce(F.sum("_load").over(before), F.lit(0)).alias("_base"),
                F.sum("_rows").over(Window.partitionBy(group)).alias("_n")),
        f"{name}-runs",
    )
    count, most = runs.agg(F.count("*"), F.max("_n")).first()
    small = F.broadcast(runs) if count <= MOST_RUNS else runs
    places = ranged.join(small, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    columns = [*df.columns, (F.col("_row") + F.col("_shift")).alias("_at"), "_n"]
    if weight is not None:
        within = Window.partitionBy("_part", group).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
        columns.append((F.col("_base") + F.coalesce(F.sum(load).over(within), F.lit(0))).alias("_before"))
    return places.select(*columns), most or 0
