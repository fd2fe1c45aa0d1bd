"""Line dedup: two Bloom filters pick suspected repeats, an exact pass settles them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.llm.common import WS_CHARS, ascii_lower, checked_broadcast, ddl, ship_package, shuffle_partitions, stage, trimmed

#: Lines shorter than this (code points of the key) are never dropped.
MIN_CHARS = 20
#: A key found in at least this many documents loses its lines in all but one.
MIN_DOCS = 3
#: Bits of a filter's first layer, bits a hash, and probes: about one false suspect in a hundred hashes.
FIRST_BITS, BITS_EACH, PROBES = 1 << 14, 10, 7
#: Bytes of all filters together up to which they are broadcast to the lines. Beyond, lines go to the filters.
BROADCAST_BYTES = 32 << 20
#: Copies of each segment's filter then, so that one line's occurrences meet it in several tasks.
REPLICAS = 8
#: Documents from which a repeated line is joined by broadcast: its lines stay where they are.
HOT_DOCS = 2_000

_NO_ID = -(1 << 63)


def _bit_positions(h: np.ndarray, bits: int) -> np.ndarray:
    """(PROBES, n) bit positions of 64-bit hashes, by double hashing."""
    h = h.astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        step = (mixed >> np.uint64(32)) | np.uint64(1)
        k = np.arange(PROBES, dtype=np.uint64)[:, None]
        return ((mixed + k * step) % np.uint64(bits)).astype(np.int64)


class Bloom:
    """A Bloom filter over 64-bit hashes that grows with them: a full layer gets one of twice its size beside it.

    Each layer holds a hash in BITS_EACH bits or more, whatever the number of hashes, so the
    share of false hits stays at a few in a hundred. One byte a bit while it is filled, one bit
    once it is packed (and no longer filled).
    """

    def __init__(self, packed: bytes | None = None):
        self.layers: list[np.ndarray] = []
        self.room = 0
        self.packed = packed is not None
        at = 0
        while packed and at < len(packed):
            size = int.from_bytes(packed[at : at + 8], "little")
            raw = zstandard.ZstdDecompressor().decompress(packed[at + 8 : at + 8 + size])
            self.layers.append(np.frombuffer(raw, np.uint8))
            at += 8 + size

    def add(self, h: np.ndarray) -> None:
        h = np.unique(h[~self.seen(h)])
        while len(h):
            if not self.room:
                self.layers.append(np.zeros(2 * len(self.layers[-1]) if self.layers else FIRST_BITS, dtype=bool))
                self.room = len(self.layers[-1]) // BITS_EACH
            now, h = h[: self.room], h[self.room :]
            self.layers[-1][_bit_positions(now, len(self.layers[-1]))] = True
            self.room -= len(now)

    def seen(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=bool)
        for bits in self.layers:
            at = _bit_positions(h, len(bits) * (8 if self.packed else 1))
            hit = bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 if self.packed else bits[at]
            out |= hit.all(axis=0)
        return out

    def pack(self) -> bytes:
        layers = [zstandard.ZstdCompressor(level=1).compress(np.packbits(x).tobytes()) for x in self.layers]
        return b"".join(len(x).to_bytes(8, "little") + x for x in layers)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map-side: each hash of a batch once, with whether it came more than once."""
    for b in batches:
        h, n = np.unique(b.column("h").to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(n > 1)], ["h", "more"])


def _build_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment -> one twice-seen filter per segment."""
    at, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([twice.pack()], pa.binary())], ["segment", "bits"])

    for b in batches:
        seg = b.column("segment").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(seg)) + 1, [len(seg)]])
        h, more = b.column("h").to_numpy(), b.column("more").to_numpy(zero_copy_only=False)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if seg[lo] != at:
                if at is not None:
                    yield done()
                at, once, twice = int(seg[lo]), Bloom(), Bloom()
            u, n = np.unique(h[lo:hi], return_counts=True)
            again = np.isin(u, h[lo:hi][more[lo:hi]]) | (n > 1) | once.seen(u)
            twice.add(u[again])
            once.add(u)
    if at is not None:
        yield done()


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (segment, replica), the filter first -> the lines the filter knows."""
    at, twice = None, None
    for b in batches:
        seg, rep = b.column("segment").to_numpy(), b.column("replica").to_numpy()
        code = seg.astype(np.int64) * REPLICAS + rep
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1, [len(code)]])
        keep = np.zeros(len(code), dtype=bool)
        h = b.column("h").fill_null(0).to_numpy()
        line = b.column("kind").to_numpy() == 1
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if code[lo] != at:
                at, twice = code[lo], Bloom(b.column("bits")[lo].as_py())
            keep[lo:hi] = line[lo:hi] & twice.seen(h[lo:hi])
        yield b.select(["id", "t", "h", "h2"]).filter(pa.array(keep))


def _known(filters, parts: int):
    """Lines -> those that the broadcast filter of their segment knows."""

    def run(batches):
        opened: dict[int, Bloom] = {}
        for b in batches:
            h = b.column("h").to_numpy()
            segment = b.column("segment").to_numpy()
            keep = np.zeros(len(h), dtype=bool)
            order = np.argsort(segment, kind="stable")
            cuts = np.searchsorted(segment[order], np.arange(parts + 1))
            for s in range(parts):
                at = order[cuts[s] : cuts[s + 1]]
                if len(at) and s in filters.value:
                    if s not in opened:
                        opened[s] = Bloom(filters.value[s])
                    keep[at] = opened[s].seen(h[at])
            yield b.select(["id", "t", "h", "h2"]).filter(pa.array(keep))

    return run


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, drops = b.column("_text").to_pylist(), b.column("_drop").to_pylist()
        hashes = b.column("_lines")
        out, dropped = [], []
        for i, text in enumerate(texts):
            if drops[i] is None:
                out.append(text)
                dropped.append(0)
                continue
            gone = np.isin(hashes[i].values.to_numpy(zero_copy_only=False), np.array(drops[i], dtype=np.int64))
            out.append("\n".join(line for line, g in zip(text.split("\n"), gone, strict=True) if not g))
            dropped.append(int(gone.sum()))
        cols = {n: b.column(n) for n in b.schema.names if n not in ("_text", "_drop", "_lines")}
        cols |= {"_kept": pa.array(out, pa.string()), "_n_lines": pa.compute.list_value_length(hashes).cast(pa.int64()),
                 "_n_dropped": pa.array(dropped, pa.int64())}
        yield pa.RecordBatch.from_pydict(cols)


def _keys(text):
    """A text's lines as comparison keys: white space stripped at both ends, A-Z lower-cased."""
    return F.transform(F.split(text, "\n"), lambda line: ascii_lower(F.trim(line, F.lit(WS_CHARS))))


def _hash(key, of_short):
    return F.when(F.char_length(key) >= MIN_CHARS, F.xxhash64(key)).otherwise(of_short)


def _at_filters(lines: DataFrame, filters: DataFrame, segment, parts: int) -> DataFrame:
    """The lines that their segment's filter knows, where filters are too large to travel."""
    probes = lines.select(
        segment.alias("segment"), F.pmod(F.xxhash64("id", "t"), F.lit(REPLICAS)).cast("int").alias("replica"),
        F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("bits"), "id", "t", "h", "h2",
    )
    copies = filters.select(
        "segment", F.explode(F.sequence(F.lit(0), F.lit(REPLICAS - 1))).alias("replica"),
        F.lit(0).alias("kind"), "bits", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("t"),
        F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("h2"),
    )
    return (
        copies.unionByName(probes).repartition(parts, "segment", "replica")
        .sortWithinPartitions("segment", "replica", "kind")
        .mapInArrow(trimmed(_suspects), "id long, t long, h long, h2 long")
    )


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines cut from ``text``, plus n_lines (before) and n_dropped.

    Keys of at least MIN_CHARS code points found in MIN_DOCS or more documents lose all
    their lines except in the largest id that holds them. Documents with one id count as
    one; a NULL id is an id below all others. NULL text counts as one empty line and
    becomes ''. Other columns pass through; n_lines and n_dropped replace columns so named.

    1. Every task sends each line hash once per batch to the hash's segment, where a
       once-seen and a twice-seen Bloom filter take it in; filters grow with their hashes.
    2. The twice-seen filters, a small share of the hashes, are broadcast to the lines, and lines
       that they do not know end where they are read. (Filters of more than BROADCAST_BYTES
       stay: line hashes go to their segment's filter, in REPLICAS copies.)
    3. Only suspects shuffle: 128-bit keys count their distinct documents exactly.
    4. Keys of very many documents are joined to their lines by broadcast, others by shuffle;
       the dropped keys of each id and text, at most as many as its lines, are joined to it.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = shuffle_partitions(spark)
    base = docs.drop("n_lines", "n_dropped")
    ident = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))
    full = F.coalesce(F.col(text), F.lit(""))
    keys = F.array_distinct(F.filter(_keys(full), lambda k: F.char_length(k) >= MIN_CHARS))
    # Rows with one id (or none) are told apart by their text where their lines are gathered.
    lines = base.select(ident.alias("id"), F.xxhash64(full).alias("t"), F.explode(keys).alias("key")).select(
        "id", "t", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(MIN_DOCS), "key").alias("h2")
    )
    segment = F.pmod(F.col("h"), F.lit(parts)).cast("int")
    filters = stage(
        lines.select("h").mapInArrow(trimmed(_combine), "h long, more boolean")
        .withColumn("segment", segment).repartition(parts, "segment").sortWithinPartitions("segment")
        .mapInArrow(trimmed(_build_filters), "segment int, bits binary"), "filters")
    if (filters.agg(F.sum(F.octet_length("bits"))).first()[0] or 0) <= BROADCAST_BYTES:
        sent = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in filters.collect()})
        known = lines.withColumn("segment", segment).mapInArrow(trimmed(_known(sent, parts)), "id long, t long, h long, h2 long")
    else:
        known = _at_filters(lines, filters, segment, parts)
    suspects = stage(known, "suspects")
    repeated = stage(
        suspects.groupBy("h", "h2", "id").agg(F.lit(1).alias("one"))
        .groupBy("h", "h2").agg(F.count("*").alias("docs"), F.max("id").alias("holder"))
        .where(F.col("docs") >= MIN_DOCS), "repeated")
    hot = checked_broadcast(repeated.where(F.col("docs") > HOT_DOCS).select("h", "h2", "holder"))
    cold = repeated.where(F.col("docs") <= HOT_DOCS).select("h", "h2", "holder")
    key = ["h", "h2"]
    lost = suspects.join(hot, key).unionByName(suspects.join(hot.select(*key), key, "left_anti").join(cold, key))
    drops = (
        lost.where(F.col("id") != F.col("holder"))
        .groupBy("id", "t").agg(F.collect_set("h").alias("_drop")).withColumnsRenamed({"id": "_id", "t": "_t"})
    )
    others = [f"_o_{c}" for c in base.columns if c != text]
    safe = base.select(*[F.col(c).alias(f"_o_{c}") if c != text else F.col(c) for c in base.columns])
    ident = F.coalesce(F.col(f"_o_{doc_id}").cast("long"), F.lit(_NO_ID))
    ready = safe.select(*others, ident.alias("_id"), F.xxhash64(full).alias("_t"), full.alias("_text")).join(drops, ["_id", "_t"], "left").select(
        *others, "_text", "_drop", F.transform(_keys(F.col("_text")), lambda k: _hash(k, F.lit(0).cast("long"))).alias("_lines"),
    )
    cut = ready.mapInArrow(trimmed(_cut_lines), ddl(safe.select(*others), "_kept string", "_n_lines long", "_n_dropped long"))
    return cut.select(
        *[F.col("_kept").alias(text) if c == text else F.col(f"_o_{c}").alias(c) for c in base.columns],
        F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
    )
