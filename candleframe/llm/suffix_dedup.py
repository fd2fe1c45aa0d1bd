"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere are cut.

Equal windows must meet in one shard. Every window of MATCH bytes is owned by its anchor,
the k-gram with the least hash in it (leftmost on ties): a function of the window's
content alone, so equal windows have equal anchors. An anchor's context is the stretch of
all windows it owns. Anchors that occur once own no repeated window and end there; equal
contexts are counted, and where one anchor has different contexts, one of each goes to
the anchor's shard, whose suffixes are ordered by external induced sorting. An anchor with
very many contexts has no shard: its windows are told apart by joins on their content.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.llm.chunks import blocks
from candleframe.llm.common import ddl, free_name, opened, ship_package, shuffle_partitions, stage, trimmed, zipped
from candleframe.llm.induced_sort import PrefixHash, repeated
from candleframe.llm.jaccard_join import mix

#: Bytes of a repeated string, and of an anchor.
MATCH, ANCHOR = 200, 32
#: Anchors that a task gathers before it sends them on.
FLUSH = 1 << 19
#: Places for the occurrences of one context beyond the first two of a flush.
SPREAD = 32
#: Context bytes of one shard, closed after the anchor that reaches them.
SHARD_BYTES = 1 << 20
#: Contexts of an anchor that are sorted in one shard; those of a hotter one are split by content.
HOT_CONTEXTS = 1 << 12

_RECORD = np.dtype([("h", "<i8"), ("cls", "<i8"), ("row", "<i8"), ("a", "<i8"), ("w", "<i4")])
_FIELDS = "h long, cls long, row long, a long, w int"


def block_anchors(data: np.ndarray, ends: np.ndarray, match: int, k: int):
    """(text number, first window, windows - 1, anchor hash, context hash) of every anchor.

    ``data``: bytes of all texts; windows never cross the ``ends`` of the texts.
    """
    none = np.zeros(0, dtype=np.int64)
    n, span = len(data), match - k + 1
    if n < match:
        return none, none, none, none, none
    grams = mix(PrefixHash(data).grams(k))
    bits = np.uint64(int(n).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    least, width = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    anchor = (least & low).astype(np.int64)
    start = np.arange(len(anchor))
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(start)]
    inside = start + match <= ends[text]
    start, anchor, text = start[inside], anchor[inside], text[inside]
    if not len(start):
        return none, none, none, none, none
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(new[1:], len(start)) - 1
    a, b, anchor, text = start[new], start[last], anchor[new], text[new]
    begin = np.concatenate([[0], ends])[text]
    raw = data.tobytes()
    shape = (anchor - a).tolist()
    cls = [xxhash.xxh3_64_intdigest(raw[i:j], s) for i, j, s in zip(a.tolist(), (b + match).tolist(), shape, strict=True)]
    return text, a - begin, b - a, grams[anchor].view(np.int64), np.array(cls, dtype=np.uint64).view(np.int64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without NULLs, and where each text ends."""
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def anchors(docs: DataFrame, match: int, k: int) -> DataFrame:
    """Occurrences (h, cls, row, a, w) of the anchors that occur twice or more in ``docs`` (row, packed text).

    Tasks send packed records to the anchor's segment, at most two per context and flush;
    further ones are known to be repeated and go to other places, so that a passage which
    a third of all documents share is spread.
    """
    parts = shuffle_partitions(docs.sparkSession)

    def find(batches):
        held: list[np.ndarray] = []

        def flush(number):
            rec = np.concatenate(held)
            held.clear()
            rec = rec[np.lexsort((rec["cls"], rec["h"]))]
            same = np.append(False, (rec["h"][1:] == rec["h"][:-1]) & (rec["cls"][1:] == rec["cls"][:-1]))
            follower = same & np.append(False, same[:-1])
            segment = rec["h"].view(np.uint64) % np.uint64(parts)
            salt = np.where(follower, 1 + (np.arange(len(rec)) + number) % SPREAD, 0)
            code = segment.astype(np.int64) * (SPREAD + 1) + salt
            order = np.argsort(code, kind="stable")
            keys, first = np.unique(code[order], return_index=True)
            cut = np.append(first, len(rec))
            rec = rec[order]
            return pa.RecordBatch.from_arrays(
                [pa.array((keys // (SPREAD + 1)).astype(np.int32)), pa.array((keys % (SPREAD + 1)).astype(np.int32)),
                 pa.array([rec[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                ["segment", "salt", "records"])

        number = 0
        for batch in batches:
            for block in (block for part in opened(batch) for block in blocks(part, "text", 1 << 20)):
                data, ends = _bytes_of(block.column("text"))
                text, a, w, h, cls = block_anchors(data, ends, match, k)
                rec = np.empty(len(text), dtype=_RECORD)
                rec["h"], rec["cls"], rec["a"], rec["w"] = h, cls, a, w
                rec["row"] = block.column("row").to_numpy()[text]
                held.append(rec)
                if sum(map(len, held)) >= FLUSH:
                    yield flush(number)
                    number += 7
        if sum(map(len, held)):
            yield flush(number)

    def decide(batches):
        first, more = [], []
        for b in batches:
            for salt, r in zip(b.column("salt").to_pylist(), b.column("records"), strict=True):
                (more if salt else first).append(np.frombuffer(r.as_buffer(), _RECORD))
        found = []
        if first:
            rec = np.concatenate(first)
            h = np.sort(rec["h"])
            found.append(rec[np.isin(rec["h"], h[1:][h[1:] == h[:-1]])])
        for rec in found + more:
            for lo in range(0, len(rec), 1 << 17):
                part = rec[lo : lo + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[c])) for c in _RECORD.names], list(_RECORD.names))

    packed = docs.select("row", "text").mapInArrow(trimmed(find), "segment int, salt int, records binary")
    return packed.repartition(parts, "segment", "salt").mapInArrow(trimmed(decide), _FIELDS)


def _unzip(column: pa.Array):
    unpack = zstandard.ZstdDecompressor()
    return (unpack.decompress(x.as_buffer()) for x in column)


def sort_contexts(contexts: DataFrame, match: int) -> DataFrame:
    """(h, cls, lo, hi): runs of owned windows of a context that another context also has.

    ``contexts`` (h, cls, w, text). Shards hold whole anchors; equal windows always have
    equal anchors, so nothing is missed between shards.
    """

    def run(batches):
        rows, size, at = [], 0, None

        def shard():
            t = np.zeros(size + len(rows), dtype=np.uint8)  # UTF-8 leaves 0 for the ends: bytes + 1 still fit
            wanted = np.zeros(len(t), dtype=bool)
            lo, place = 0, []
            for _, _, w, text in rows:
                t[lo : lo + len(text)] = np.frombuffer(text, np.uint8)
                t[lo : lo + len(text)] += 1
                wanted[lo : lo + w + 1] = True
                place.append(lo)
                lo += len(text) + 1
            flag = repeated(t, wanted, match)
            out = []
            for (h, cls, w, _), lo in zip(rows, place, strict=True):
                own = np.concatenate([[False], flag[lo : lo + w + 1], [False]])
                edge = np.flatnonzero(own[1:] != own[:-1])
                out += [(h, cls, a, b - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["h", "cls", "lo", "hi"])

        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in ("h", "cls", "w", "text")], strict=True):
                if row[0] != at and size >= SHARD_BYTES:
                    yield shard()
                    rows, size = [], 0
                at = row[0]
                rows.append(row)
                size += len(row[3])
        if rows:
            yield shard()

    dealt = contexts.repartition(shuffle_partitions(contexts.sparkSession), "h").sortWithinPartitions("h")
    return dealt.mapInArrow(trimmed(run), "h long, cls long, lo long, hi long")


def split_contexts(contexts: DataFrame, match: int, k: int) -> DataFrame:
    """(h, cls, lo, hi), as ``sort_contexts``, of hot anchors: no task takes all of an anchor.

    Equal windows hold their anchor at the same place. So the windows of a context are taken
    in intervals of that place, and what all windows of an interval have in common, a stretch
    of ``match - width + 1`` bytes around the anchor, is counted over all contexts. A stretch
    that only one context has cannot lie in a repeated window, and its interval ends there;
    the others are halved, down to single windows, where the stretch is the window itself.
    """

    def locate(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                texts = b.column("text").to_pylist()
                data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(x) for x in texts])
                grams = mix(PrefixHash(data).grams(k)).view(np.int64)
                start = np.cumsum(sizes) - sizes
                owner = np.repeat(np.arange(len(texts)), sizes)[: len(grams)]
                same = np.flatnonzero(grams == b.column("h").to_numpy()[owner])
                found, first = np.unique(owner[same], return_index=True)  # the leftmost is the anchor
                place = np.zeros(len(texts), dtype=np.int64)
                place[found] = same[first] - start[found]
                yield b.append_column("place", pa.array(place))

    width = 1
    while 4 * width <= match - k + 1:
        width *= 2
    # ``r``: the anchor's place in a window; a context owns the windows from place - w to place.
    r_lo, r_hi = F.col("place") - F.col("w"), F.col("place")
    state = contexts.mapInArrow(trimmed(locate), "h long, cls long, w int, text binary, place long").withColumn(
        "part", F.explode(F.sequence(F.floor(r_lo / width), F.floor(r_hi / width))))
    while True:
        left = F.col("place") - F.col("part") * width - (width - 1)
        stretch = F.substr("text", (left + width).cast("int"), F.lit(match - width + 1))
        keyed = stage(state.withColumns({"k1": F.xxhash64(stretch), "k2": F.xxhash64(F.lit(width), stretch)}), "stretches")
        key = ["h", "part", "k1", "k2"]
        again = keyed.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
        kept = keyed.join(again, key, "left_semi")
        if width == 1:
            i = F.col("place") - F.col("part")
            return kept.select("h", "cls", i.alias("lo"), i.alias("hi"))
        width //= 2
        halves = F.explode(F.array(2 * F.col("part"), 2 * F.col("part") + 1))
        state = kept.select("h", "cls", "w", "text", "place", halves.alias("part")).where(
            (F.col("part") * width <= r_hi) & ((F.col("part") + 1) * width > r_lo))


def suffix_dedup(docs: DataFrame, match: int = MATCH, k: int = ANCHOR, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` but with kept (binary), n_bytes, n_removed and n_spans.

    A byte goes if a string of ``match`` bytes that covers it also starts anywhere else, in
    any document or the same one, judged on the input; matches never cross documents. NULL
    and empty texts have no bytes. Rows are numbered once, in a staged table, and told apart by
    that number alone: ids may be NULL or tied, and fully repeated rows each lose their
    repeated bytes (they repeat each other). Columns named like a new one, in any case, are
    replaced; others pass through.
    """
    spark = docs.sparkSession
    ship_package(spark)
    new = ["kept", "n_bytes", "n_removed", "n_spans"]
    others = [c for c in docs.columns if c != text and c.lower() not in new]
    packed = stage(zipped(docs.select(
        *[F.col(f"`{c}`").alias(f"_o_{c}") for c in others], F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))), "numbered")
    found = stage(anchors(packed, match, k), "anchors")
    classes = stage(found.groupBy("h", "cls").agg(F.count("*").alias("n"), F.min(F.struct("row", "a", "w")).alias("at")), "contexts")
    several = classes.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select(
        "h", (F.col("kinds") > HOT_CONTEXTS).alias("hot"))
    torn = classes.join(several, "h").select("at.row", F.struct("h", "cls", "at.a", "at.w", "hot").alias("c"))
    per_doc = torn.groupBy("row").agg(F.collect_list("c").alias("cs"))

    def cut_contexts(batches):
        for b in batches:
            for raw, cs in zip(_unzip(b.column("text")), b.column("cs").to_pylist(), strict=True):
                for lo in range(0, len(cs), 4096):
                    part = cs[lo : lo + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c["h"] for c in part], pa.int64()), pa.array([c["cls"] for c in part], pa.int64()),
                         pa.array([c["w"] for c in part], pa.int32()),
                         pa.array([raw[c["a"] : c["a"] + c["w"] + match] for c in part], pa.binary()),
                         pa.array([c["hot"] for c in part], pa.bool_())], ["h", "cls", "w", "text", "hot"])

    contexts = packed.select("row", "text").join(per_doc, "row").select("cs", "text").mapInArrow(trimmed(cut_contexts), "h long, cls long, w int, text binary, hot boolean")
    columns = ["h", "cls", "w", "text"]
    if several.where("hot").isEmpty():
        runs = stage(sort_contexts(contexts.select(*columns), match), "runs")
    else:
        contexts = stage(contexts, "cut-contexts")
        runs = stage(sort_contexts(contexts.where("NOT hot").select(*columns), match).unionByName(
            split_contexts(contexts.where("hot").select(*columns), match, k)), "runs")
    # A context that occurs twice is repeated whole; in others, the runs that the sort found.
    verdict = classes.where("n > 1").select("h", "cls", F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("at.w").cast("long").alias("hi"))).alias("runs")).unionByName(
        runs.join(classes.where("n = 1").select("h", "cls"), ["h", "cls"]).groupBy("h", "cls").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")))
    spans = found.join(verdict, ["h", "cls"]).select("row", "a", F.explode("runs").alias("r")).select(
        "row", F.struct((F.col("a") + F.col("r.lo")).alias("lo"), (F.col("a") + F.col("r.hi") + match).alias("hi")).alias("s"))
    per_doc = spans.groupBy("row").agg(F.collect_set("s").alias("spans"))
    kept_names = [f"_o_{c}" for c in others]

    def cut(batches):
        for b in batches:
            kept, size, gone, runs_n = [], [], [], []
            for raw, spans in zip(_unzip(b.column("text")), b.column("spans"), strict=True):
                size.append(len(raw))
                if not spans.is_valid:
                    kept.append(raw)
                    gone.append(0)
                    runs_n.append(0)
                    continue
                s = spans.values
                lo, hi = (pc.struct_field(s, f).to_numpy(zero_copy_only=False) for f in ("lo", "hi"))
                by = np.argsort(lo, kind="stable")
                lo, hi = lo[by], np.maximum.accumulate(hi[by])
                head = np.append(True, lo[1:] > hi[:-1])
                starts, stops = lo[head], np.append(hi[:-1][head[1:]], hi[-1])
                edges = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(raw)]
                kept.append(b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
                gone.append(int((stops - starts).sum()))
                runs_n.append(len(starts))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept_names], pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (size, gone, runs_n)]],
                [*kept_names, *new])

    joined = packed.join(per_doc, "row", "left").select(*kept_names, "text", "spans")
    out = joined.mapInArrow(trimmed(cut), ddl(packed.select(*kept_names), "kept binary, n_bytes long, n_removed long, n_spans long"))
    return out.select(*[F.col(f"_o_{c}").alias(c) for c in others], *new)


def valid_text(df: DataFrame, kept: str = "kept", out: str = "text") -> DataFrame:
    """``df`` with ``out``: the bytes of ``kept`` as text, without characters that a cut has split."""
    rest = df.drop(out, kept)
    at = free_name(df.columns, "_k")

    def run(batches):
        for b in batches:
            text = [x.as_buffer().to_pybytes().decode(errors="ignore") for x in b.column(at)]
            yield b.drop_columns([at]).append_column(out, pa.array(text, pa.string()))

    return df.select(*rest.columns, F.col(kept).alias(at)).mapInArrow(trimmed(run), ddl(rest, f"`{out}` string"))
