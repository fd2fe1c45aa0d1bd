"""Token-ID files: one zstandard frame per document and a trailing seek table.

A file is a plain sequence of zstandard frames, so any zstandard tool can read it:

* data frames, one per document: its ids as little-endian uint32, with content checksum;
* an empty skippable frame after every written bundle (Spark's text writer puts a line
  separator after each record, and this separator is one such frame);
* last, a skippable frame with the seek table: an entry for each document, then a footer
  with the number of entries and a magic number.

Spark writes the files through its own committed output, so a lost or repeated task leaves
no half-written file, on any file system that Spark knows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candleframe.llm.chunks import blocks
from candleframe.llm.common import ship_package, trimmed
from candleframe.llm.word_bpe import WordEncoder

#: An empty skippable frame: magic 0x184D2A50 and a size of 0; all ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
#: The seek table's own skippable frame, and the last bytes of the table.
TABLE_MAGIC = 0x184D2A5E
FOOTER = "<QI"
FOOTER_MAGIC = 0x8F92EAB1
#: doc_id, whether it is NULL, offset of the frame, its size, ids in it, crc32 of their bytes.
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("size", "<u4"), ("n_ids", "<u8"), ("crc", "<u4")])

END_ID = 1


def with_end(ids: np.ndarray, n: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Every document's ids followed by ``end_id``."""
    return np.insert(ids, np.cumsum(n), end_id).astype("<u4"), n + 1


def encode_rows(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, ids of all, ends of each) for blocks of documents, the end id included."""
    encoder = WordEncoder.load(tokenizer)
    for batch in batches:
        for block in blocks(batch, "text"):
            ids, n = with_end(*encoder.encode(block.column("text")))
            yield block.column("doc_id").to_pylist(), ids, np.cumsum(n)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` as token files below ``path``, in ascending id order over all files.

    NULL ids come first; rows with one id follow each other in the order of their texts'
    hashes. NULL and empty texts hold the end id alone. Other columns are not written.
    The one shuffle ranges the documents by id; files follow its partitions.
    """
    ship_package(docs.sparkSession)

    def frames(batches):
        pack = zstandard.ZstdCompressor(level=3, write_checksum=True)
        entries, at = [], 0
        for doc_ids, ids, ends in encode_rows(batches, tokenizer):
            raw = memoryview(ids.tobytes())
            entry = np.zeros(len(doc_ids), dtype=ENTRY)
            bundle, lo = [], 0
            for i, hi in enumerate(ends.tolist()):
                body = raw[4 * lo : 4 * hi]
                frame = pack.compress(body)
                entry[i] = (doc_ids[i] or 0, doc_ids[i] is None, at, len(frame), hi - lo, zlib.crc32(body))
                bundle.append(frame)
                at += len(frame)
                lo = hi
            at += len(SEPARATOR)
            entries.append(entry)
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(bundle)], pa.binary())], ["frame"])
        if entries:
            table = np.concatenate(entries)
            body = table.tobytes() + struct.pack(FOOTER, len(table), FOOTER_MAGIC)
            last = struct.pack("<II", TABLE_MAGIC, len(body)) + body
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary())], ["frame"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    (
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(trimmed(frames), "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR.decode("ascii")).text(path)
    )


def seek_table(content: memoryview) -> np.ndarray:
    """The entries of one file; checks the magic numbers."""
    end = len(content) - len(SEPARATOR)
    size = struct.calcsize(FOOTER)
    count, magic = struct.unpack(FOOTER, content[end - size : end])
    if magic != FOOTER_MAGIC or bytes(content[end:]) != SEPARATOR:
        raise ValueError("not a token file: its last bytes are not a seek table's")
    start = end - size - count * ENTRY.itemsize
    return np.frombuffer(content[start : end - size], dtype=ENTRY)


def _files(spark: SparkSession, path: str) -> DataFrame:
    number = F.regexp_extract(F.col("path"), r"part-(\d+)", 1).cast("int")
    return spark.read.format("binaryFile").load(path).where("length > 0").select(number.alias("file"), "content")


def _id_column(table: np.ndarray) -> pa.Array:
    return pa.array(table["doc_id"], pa.int64(), mask=table["null"].astype(bool))


def _totals(batches):
    for b in batches:
        tables = [seek_table(memoryview(c.as_buffer())) for c in b.column("content")]
        yield pa.RecordBatch.from_arrays(
            [b.column("file"), pa.array([int(t["n_ids"].sum()) for t in tables], pa.int64())], ["file", "total"])


def read_token_files(
    spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """Documents of the files below ``path``: doc_id, start, n_tokens, ids_crc32 and, if asked, ids.

    ``start``: ids of all documents before it, over all files. With ``doc_ids``, only the
    frames of those documents are decompressed. A frame whose checksum or length differs
    from its entry raises. No files: no rows.
    """
    ship_package(spark)
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), dtype=np.int64)

    def documents(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for file, content in zip(b.column("file").to_pylist(), b.column("content"), strict=True):
                view = memoryview(content.as_buffer())
                table = seek_table(view)
                before = np.cumsum(table["n_ids"]).astype(np.int64) - table["n_ids"].astype(np.int64)
                if wanted is not None:
                    take = np.isin(table["doc_id"], wanted) & (table["null"] == 0)
                    table, before = table[take], before[take]
                for lo in range(0, len(table), 512):
                    part = table[lo : lo + 512]
                    raws, crcs = [], []
                    for e in part:
                        at = int(e["offset"])
                        raw = unpack.decompress(view[at : at + int(e["size"])])
                        crcs.append(zlib.crc32(raw))
                        if crcs[-1] != e["crc"] or len(raw) != 4 * int(e["n_ids"]):
                            raise ValueError(f"file {file}: the frame at {at} differs from its entry")
                        raws.append(np.frombuffer(raw, "<u4") if with_ids else None)
                    cols = [
                        pa.array([file] * len(part), pa.int32()), _id_column(part),
                        pa.array(before[lo : lo + 512]), pa.array(part["n_ids"].astype(np.int64)),
                        pa.array(crcs, pa.int64()),
                    ]
                    names = ["file", "doc_id", "before", "n_tokens", "ids_crc32"]
                    if with_ids:
                        cols.append(pa.array([r.astype(np.int64) for r in raws], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(cols, names)

    schema = "file int, doc_id long, before long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    files = _files(spark, path)
    # One row per file.
    up_to = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = files.mapInArrow(trimmed(_totals), "file int, total long").select(
        "file", F.coalesce(F.sum("total").over(up_to), F.lit(0)).cast("long").alias("base"))
    rows = files.mapInArrow(trimmed(documents), schema).join(base, "file")
    return rows.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
