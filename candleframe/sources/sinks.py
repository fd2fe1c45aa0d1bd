"""Parquet sink for extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleframe.session import checked_broadcast, checkpointed

#: Rows of a file, about: at 20 to 40 bytes a packed extract row, 100 to 200 MB.
FILE_ROWS = 5_000_000


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: tuple[str, ...] = ("base_currency",),
) -> None:
    """Write ``df`` as Parquet; by default fails if ``path`` exists, like a plain ``write``.

    Partitioned by base so later reads of a few bases prune directories. Each task writes
    its own files (no shuffle before the write): right for few tasks or few bases.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def deal_by_size(df: DataFrame, partition_by: tuple[str, ...] = ("base_currency",), *, file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` dealt out so that each task holds one file's rows of one partition value.

    Rows are counted per value first (one pass over those columns, merged map-side). A value of
    n rows gets ceil(n / ``file_rows``) places, and a row takes one by a hash of its
    columns, the same on every attempt: files hold between half of ``file_rows`` and a little
    more than it (all rows of a smaller value), a hot value is spread over as many tasks
    as it has files, and no value is written by many tasks. Rows equal in every column
    share a place.
    """
    keys = list(partition_by)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_places", F.ceil(F.col("_n") / file_rows).cast("bigint"))
    # One row a value: summed in the order of the values.
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    places = checkpointed(counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_places",
        F.coalesce(F.sum("_places").over(before), F.lit(0)).alias("_first")))
    total = places.agg(F.sum("_places")).first()[0] or 1
    same = None
    for i, k in enumerate(keys):
        equal = df[k].eqNullSafe(places[f"_k{i}"])
        same = equal if same is None else same & equal
    place = (F.col("_first") + F.pmod(F.xxhash64(*[df[c] for c in df.columns]), F.col("_places"))).cast("int")
    placed = df.join(checked_broadcast(places), same).select(*[df[c] for c in df.columns], place.alias("_place"))
    return placed.repartitionById(int(total), F.col("_place")).drop("_place")


def write_by_size(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: tuple[str, ...] = ("base_currency",),
    file_rows: int = FILE_ROWS,
) -> None:
    """``write_parquet`` with files of about ``file_rows`` rows, whatever the number of tasks (``deal_by_size``).

    The rows are shuffled once, and ``df`` is read twice: first only the columns of ``partition_by``.
    """
    write_parquet(deal_by_size(df, partition_by, file_rows=file_rows), path, mode=mode, partition_by=partition_by)
