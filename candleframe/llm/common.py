"""Shared helpers: table access, staged tables, shipping code, gapless ranks."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleframe.session import ensure_checkpoint_dir

#: The white space of every word and line rule: ``[\x20\x09-\x0D]``.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back.

    Cuts lineage like a checkpoint: the files are shared, so a lost executor loses nothing
    and no branch computes ``df`` again; unlike a checkpoint, readers prune columns.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    A no-op where ``PYTHONPATH`` already names the repository; otherwise the package goes
    to the executors with ``addPyFile``, once per application.
    """
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(here)
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if root in on_path or app in _shipped:
        return
    to = os.path.join(tempfile.mkdtemp(prefix="candleframe-code-"), "candleframe_code.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(to)
    _shipped.add(app)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, for mapInArrow, that gives memory back to the system when a partition ends.

    Python workers outlive tasks; what their allocators keep would add up.
    """

    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # the C library has no such call
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def checked_broadcast(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """A staged slim table, marked for broadcast if it has at most ``most_rows`` rows.

    Beyond that it is joined by shuffle, where AQE splits skewed partitions.
    """
    few = df.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(df) if few else df


def ddl(df: DataFrame, *more: str) -> str:
    """The schema of ``df`` and some more columns as DDL."""
    return ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], *more])


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def free_prefix(columns: list[str], prefix: str) -> str:
    """``prefix``, with underscores before it until no column starts with it."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix = f"_{prefix}"
    return prefix


def zipped(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with a string column as zstandard frames, so that a shuffle moves and keeps less."""
    ship_package(df.sparkSession)
    rest = df.drop(column)
    z = free_name(df.columns, "_z")

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = [pack.compress(x.as_buffer()) if x.is_valid else None for x in b.column(z).cast(pa.binary())]
            yield b.set_column(b.schema.get_field_index(z), z, pa.array(packed, pa.binary()))

    out = df.select(*rest.columns, F.col(column).alias(z)).mapInArrow(trimmed(run), ddl(rest, f"`{z}` binary"))
    return out.select(*[F.col(z).alias(column) if c == column else F.col(c) for c in df.columns])


def unzipped(df: DataFrame, column: str = "text") -> DataFrame:
    """The strings of a column that ``zipped`` made."""
    rest = df.drop(column)
    z = free_name(df.columns, "_z")

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                t = pa.array([unpack.decompress(x.as_buffer()) if x.is_valid else None for x in part.column(z)], pa.binary())
                yield part.set_column(part.schema.get_field_index(z), z, t.cast(pa.string()))

    out = df.select(*rest.columns, F.col(column).alias(z)).mapInArrow(trimmed(run), ddl(rest, f"`{z}` string"))
    return out.select(*[F.col(z).alias(column) if c == column else F.col(c) for c in df.columns])


def opened(batch: pa.RecordBatch, column: str = "text", limit: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with the strings of a column that ``zipped`` made, about ``limit`` bytes each.

    For use within a mapInArrow function: a task then needs one Python worker, not two.
    """
    unpack, place = zstandard.ZstdDecompressor(), batch.schema.get_field_index(column)
    texts, size, first = [], 0, 0
    for i, x in enumerate(batch.column(place)):
        texts.append(unpack.decompress(x.as_buffer()) if x.is_valid else None)
        size += len(texts[-1] or b"")
        if size >= limit or i + 1 == batch.num_rows:
            part = batch.slice(first, len(texts))
            yield part.set_column(place, column, pa.array(texts, pa.binary()).cast(pa.string()))
            texts, size, first = [], 0, i + 1


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(c: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; none for NULL."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{WS_CLASS}+"), lambda w: w != "")


def gapless_rank(df: DataFrame, groups: list[str], order: list[str], out: str, n_rows: int) -> DataFrame:
    """``df`` with ``out``: 0, 1, 2, ... without gaps within each value of ``groups``.

    No task ever ranks a whole hot group: each group is cut into ``ceil(size / target)``
    salts by the hash of ``order``, ranks are taken per salt, and the sizes of the salts
    before it are added. ``target`` is a quarter of an even share of ``n_rows``, so there
    are at most ``groups + 4 * shuffle partitions`` salts. ``df`` is read twice: stage it.
    The number of groups must be bounded (shards, lengths): their sizes are joined back.
    """
    target = max(1, n_rows // (4 * shuffle_partitions(df.sparkSession)))
    sizes = df.groupBy(*groups).agg(F.ceil(F.count("*") / F.lit(target)).cast("int").alias("_salts"))
    salted = df.join(F.broadcast(sizes), groups).withColumn(
        "_salt", F.pmod(F.xxhash64(F.lit(out), *order), F.col("_salts")).cast("int")
    ).drop("_salts")
    w = Window.partitionBy(*groups).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        salted.groupBy(*groups, "_salt").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long")).drop("_n")
    )
    in_salt = Window.partitionBy(*groups, "_salt").orderBy(*order)
    ranked = salted.withColumn("_rank", F.row_number().over(in_salt).cast("long"))
    return (
        ranked.join(before, [*groups, "_salt"])
        .withColumn(out, F.col("_before") + F.col("_rank") - 1)
        .drop("_salt", "_before", "_rank")
    )
