"""WARC archives: sharded writer with the same bytes on any cluster, and a reader.

A record is a gzip member of its own, so any WARC tool reads the files. All pages are put
into one total order; shards are ranges of it with about the same payload bytes, and a
shard's task rolls to a new file when the compressed size reaches a limit. Files are
written under temporary names by Spark's committed output, checked, renamed, and count only
once the manifest that lists them is renamed into place.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleframe.llm.common import checked_broadcast, ship_package, stage, trimmed, zipped
from candleframe.llm.ordered import placed

#: Payload bytes of a shard (one task), and compressed bytes at which a file is rolled.
SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
#: A record's headers count as so many bytes of its shard.
HEADER_BYTES = 1024
#: Shards whose bounds, about 100 bytes each, still go to every task.
MOST_SHARDS = 1_000_000
#: The date of records without one of their own: output does not depend on the clock.
DATE = "2000-01-01T00:00:00Z"
LEVEL = 6
MANIFEST = "MANIFEST"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = ("file string, offset long, record_id string, record_type string, page_id long, url string, date string, "
           "payload_digest string, payload_bytes long, refers_to_record string, refers_to long")


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(at: int, page_id: int | None, payload_digest: str) -> str:
    """A record's URN, from its place in the total order and its content alone."""
    seed = hashlib.sha256(f"{at}\n{page_id}\n{payload_digest}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=seed, version=4)}>"


def target(url: str | None) -> str | None:
    """A URL as header value: white space and control characters percent-encoded."""
    return None if url is None else "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)  # no name, no time
    return pack.compress(data) + pack.flush()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record: version line, the fields that are not None, and the block."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class _File:
    """The members of the file that a shard is writing."""

    shard: int
    roll: int
    first: int
    level: int

    def __post_init__(self):
        self.members, self.size, self.records = [], 0, 0

    def add(self, data: bytes) -> None:
        self.members.append(gzip_member(data, self.level))
        self.size += len(self.members[-1])
        self.records += 1

    def content(self) -> bytes:
        """The file without its last byte, 0, which the text writer's separator supplies."""
        about = {"shard": self.shard, "roll": self.roll, "first": self.first, "records": self.records}
        block = json.dumps(about, sort_keys=True).encode()
        info = record([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(-1 - self.first, None, digest(block))), ("WARC-Date", DATE),
            ("WARC-Filename", name_of(self.shard, self.roll)), ("WARC-Block-Digest", f"sha1:{digest(block)}"),
            ("Content-Type", "application/json")], block)
        whole = b"".join([gzip_member(info, self.level), *self.members])
        # A member ends with its size; beyond 16 MiB that ends in another byte than 0.
        return whole[:-1] if whole[-1] == 0 else (whole + gzip_member(b""))[:-1]


def name_of(shard: int, roll: int) -> str:
    return f"pages-{shard:07d}-{roll:05d}.warc.gz"


def _page_record(at: int, r: dict, payload: bytes, refers: dict | None) -> bytes:
    """A response with its payload, or a revisit of the record that ``refers`` names."""
    own = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", record_id(at, r["page_id"], own)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target(r["url"])),
        ("WARC-Page-ID", r["page_id"]),
        ("WARC-Payload-Digest", f"sha1:{own}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if refers:
        fields += [
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", record_id(refers["refers_at"], refers["refers_page"], own)),
            ("WARC-Refers-To-Page-ID", refers["refers_page"]),
            ("WARC-Refers-To-Target-URI", target(refers["refers_url"])),
            ("WARC-Refers-To-Date", DATE),
        ]
    return record([*fields, ("Content-Type", "application/http; msgtype=response")], block)


def _order_key():
    """One string that sorts as (page_id with NULL first, payload hash, url, row of the staged table)."""
    def padded(c):
        return F.lpad(F.hex(c), 16, "0")

    page = F.coalesce(F.concat(F.lit("1"), padded(F.col("page_id").bitwiseXOR(F.lit(-(2**63))))), F.lit("0"))
    return F.concat(page, F.col("key"), padded(F.xxhash64("url")), padded(F.col("row")))


def write_warc(
    pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, level: int = LEVEL,
) -> None:
    """Write one record per row of ``pages`` below ``path``, which must hold no archive yet.

    Payload: the html in UTF-8, nothing for NULL. Of rows with equal payloads of at least
    ``min_bytes``, the one with the largest page_id (of tied ones, the last in the order) is
    the response, others are revisits of it. Order: page_id (NULL first), payload, url;
    equal rows take any places among them. A NULL url or page_id leaves its header out. Other
    columns are not written. The files' bytes depend on the rows and parameters only.

    A first pass hashes the payloads and stages them packed. Slim rows without payloads then
    give the order, the shards' bounds and the revisits; a second pass sends each payload once, to
    its shard. Hot payloads are counted map-side; bounds are a small sorted array.
    """
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("text"))
    packed = stage(zipped(rows.withColumns({
        "row": F.monotonically_increasing_id(), "key": F.sha2("text", 256), "bytes": F.octet_length("text").cast("long")})), "warc-pages")
    slim = packed.select("page_id", "url", "key", "bytes", _order_key().alias("o"), F.lit(0).alias("g"))
    ordered, _ = placed(slim.withColumn("load", F.col("bytes") + HEADER_BYTES), "g", ["o"], "warc-order", weight="load")
    ordered = stage(ordered.select(
        "page_id", "url", "key", "bytes", "o", F.col("_at").alias("at"), F.floor(F.col("_before") / shard_bytes).cast("int").alias("shard")), "warc-shards")
    starts = ordered.groupBy("shard").agg(F.min("o").alias("o"), F.min("at").alias("at")).orderBy("shard").limit(MOST_SHARDS + 1).collect()
    if len(starts) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards: increase shard_bytes")
    # The order rises with the page_id, so the last row of a payload has its largest one.
    last = F.max_by(F.struct("page_id", "url"), "at")
    copied = stage(
        ordered.where(F.col("bytes") >= min_bytes).groupBy("key")
        .agg(F.count("*").alias("n"), F.max("at").alias("refers_at"), last.alias("last")).where("n > 1")
        .select(F.col("key").alias("k"), "refers_at", F.col("last.page_id").alias("refers_page"), F.col("last.url").alias("refers_url")),
        "warc-copies")
    revisits = ordered.join(checked_broadcast(copied), (F.col("key") == F.col("k")) & (F.col("at") < F.col("refers_at"))).select(
        "o", "refers_at", "refers_page", "refers_url")

    bounds = np.array([s.o.encode() for s in starts[1:]], dtype="S")
    first = [s.at for s in starts]
    columns = ["shard", "o", "page_id", "url", "text", "refers_at", "refers_page", "refers_url"]
    schema = "shard int, o string, page_id long, url string, text binary, refers_at long, refers_page long, refers_url string"

    def in_shard(batches):
        for b in batches:
            o = np.array(b.column("o").cast(pa.binary()).to_pylist(), dtype="S")
            shard = np.searchsorted(bounds, o, side="right").astype(np.int32) if len(bounds) else np.zeros(len(o), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *[b.column(c) for c in columns[1:]]], columns)

    def archives(batches):
        unpack = zstandard.ZstdDecompressor()
        now, at, refers = None, 0, None
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i].as_py() for c in columns}
                if r["text"] is None:  # it comes before the page of the same order key
                    refers = r
                    continue
                if now is None or r["shard"] != now.shard:
                    if now:
                        yield _one(now)
                    at = first[r["shard"]]
                    now = _File(r["shard"], 0, at, level)
                elif now.size >= file_bytes:
                    yield _one(now)
                    now = _File(now.shard, now.roll + 1, at, level)
                now.add(_page_record(at, r, unpack.decompress(r["text"]), refers if refers and refers["o"] == r["o"] else None))
                at += 1
        if now:
            yield _one(now)

    staged = f"{path}/tmp-{uuid.uuid4().hex}"
    sent = packed.select(_order_key().alias("o"), "page_id", "url", "text").unionByName(revisits, allowMissingColumns=True)
    (
        sent.select(*[F.col(c) if c != "text" else F.col(c).cast("binary").alias(c) for c in columns[1:]])
        .mapInArrow(trimmed(in_shard), schema)
        .repartitionById(max(1, len(starts)), F.col("shard"))
        .sortWithinPartitions("shard", "o", F.col("text").isNotNull())
        .mapInArrow(trimmed(archives), "content binary")
        .select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(staged)
    )
    _commit(spark, path, staged)


def _one(file: _File) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file.content()], pa.binary())], ["content"])


ENTRY = "name string, bytes long, sha256 string, records long, first long"


def _commit(spark: SparkSession, path: str, staged: str) -> None:
    """Check the files of ``staged``, give them their names, and put the manifest in place last.

    Until then a reader finds no manifest; a job that is stopped leaves only its temporary
    folder and, at worst, named files that no manifest lists.
    """

    def entries(batches):
        for b in batches:
            rows = []
            for p, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                _, raw = next(members(data))
                about = json.loads(parse(raw)[1])
                rows.append((p, name_of(about["shard"], about["roll"]), len(data), hashlib.sha256(data).hexdigest(), about["records"], about["first"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()], strict=True)],
                ["path", "name", "bytes", "sha256", "records", "first"])

    files = spark.read.format("binaryFile").load(staged).where("length > 0").select("path", "content")
    listed = stage(files.mapInArrow(trimmed(entries), f"path string, {ENTRY}"), "warc-files")
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def rename(old: str, new: str) -> None:
        if fs.exists(jvm.Path(new)) or not fs.rename(jvm.Path(old), jvm.Path(new)):
            raise FileExistsError(f"{new}: not renamed from {old}")

    for r in listed.select("path", "name").toLocalIterator():
        rename(r.path, f"{path}/{r.name}")
    manifest = f"{staged}-manifest"
    listed.drop("path").coalesce(1).sortWithinPartitions("name").write.json(manifest)
    rename(manifest, f"{path}/{MANIFEST}")
    fs.delete(jvm.Path(staged), True)


def members(data: memoryview) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member."""
    at = 0
    while at < len(data):
        start, unpack, parts = at, zlib.decompressobj(31), []
        while not unpack.eof:
            step = data[at : at + 65536]
            if not len(step):
                raise ValueError(f"the member at {start} is cut off")
            parts.append(unpack.decompress(step))
            at += len(step) - len(unpack.unused_data)
        whole = b"".join(parts)
        if whole:
            yield start, whole


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; a block that differs from its digest raises."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    block = rest[:size]
    if version != "WARC/1.1" or rest[size:] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is damaged")
    return fields, block


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The page records of the files that the manifest below ``path`` lists, checked against it.

    ``payload_digest`` and ``payload_bytes`` are of the full payload, for revisits too;
    ``refers_to``: the page_id of the response that a revisit names. With ``with_payload``,
    also the payload's bytes (NULL for revisits). A file, block or payload that differs from
    its digest raises; files that no manifest lists are not read. No manifest: an error.
    """
    ship_package(spark)
    listed = {r.name: (r.bytes, r.sha256) for r in spark.read.schema(ENTRY).json(f"{path}/{MANIFEST}").toLocalIterator()}
    schema = RECORDS + (", payload binary" if with_payload else "")
    if not listed:
        return spark.createDataFrame([], schema)

    def row(name: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rpartition(b"Content-Length: ")[2])
        revisit = fields["WARC-Type"] == "revisit"
        own = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if not revisit and (len(payload) != size or digest(payload) != own):
            raise ValueError(f"{name}: the payload at {offset} differs from its digest")
        number = [int(fields[k]) if k in fields else None for k in ("WARC-Page-ID", "WARC-Refers-To-Page-ID")]
        return (name, offset, fields["WARC-Record-ID"], fields["WARC-Type"], number[0], fields.get("WARC-Target-URI"), fields["WARC-Date"],
                own, size, fields.get("WARC-Refers-To"), number[1], *([None if revisit else payload] if with_payload else []))

    kinds = [pa.string(), pa.int64(), *[pa.string()] * 2, pa.int64(), *[pa.string()] * 3, pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)], names)

    def records(batches):
        for b in batches:
            for name, content in zip(b.column("name").to_pylist(), b.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                if (len(data), hashlib.sha256(data).hexdigest()) != listed[name]:
                    raise ValueError(f"{name} differs from the manifest")
                rows, held = [], 0
                for offset, raw in members(data):
                    fields, block = parse(raw)
                    if fields["WARC-Type"] != "warcinfo":
                        rows.append(row(name, offset, fields, block))
                        held += len(block) if with_payload else 0
                    if len(rows) == 4096 or held > 1 << 25:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").load([f"{path}/{n}" for n in listed])
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInArrow(trimmed(records), schema)
