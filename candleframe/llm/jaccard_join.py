"""N-gram Jaccard join: exact links of documents whose word shingles largely agree.

Jaccard distance is a metric, but texts without a common shingle are all at distance 1,
where Voronoi regions of pivots cannot part them. So regions are first cut by an exact
key: a pair that links differs in at most H shingles; spread over H + K hash buckets, at
least K buckets of the pair agree completely. Documents that share such a bucket form a
cell; members of a cell whose bucket counts are close enough (a lower bound of their
distance) are connected, connected documents form a region, and inside a region distances tell documents apart:
every member is measured against the region's pivot. Those within the radius are joined;
the far ones get pivots of their own, round by round. Members of different pivots, or of
none, are compared if their distances to the first pivot differ by no more than the radius
(the triangle inequality's window) and they share one of their first shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.llm.chunks import blocks
from candleframe.llm.common import checked_broadcast, opened, ship_package, shuffle_partitions, stage, trimmed, zipped
from candleframe.llm.components import connected_components

#: Words in a shingle and the least similarity, as a fraction, of the registered query.
WORDS, SIMILARITY = 4, (85, 100)
#: Signatures that a task gathers before it sends them on, sorted by segment.
FLUSH = 1 << 21
#: Members of a region that meet its pivot in one part, and are then joined in it.
PART_ROWS = 4096
#: Shingles of all members of such a part (8 bytes each, several times over while it is joined).
PART_SHINGLES = 1 << 24
#: Hash buckets that agree in a pair that links, at least, beyond those likely to be empty.
AGREE = 2
#: Buckets of the smallest and of the largest sets' sketches, one byte each.
MIN_SKETCH, MAX_SKETCH = 64, 2048
#: Members of a cell that one task compares; those of larger cells meet in tiles of twice as many.
CELL_ROWS = 1 << 15
#: Further pivots that a region of several parts gets, one after the other.
PIVOT_ROUNDS = 3

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift), elementwise."""
    h = h.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(30)
        h *= _M1
        h ^= h >> np.uint64(27)
        h *= _M2
        h ^= h >> np.uint64(31)
    return h


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all distinct shingles, ascending in each text; how many each text has).

    A-Z are lower-cased; words are runs without ASCII white space. Fewer words than a
    shingle takes make one shingle; no words, an empty set. NULL counts as empty.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = lists.flatten().dictionary_encode()
    names = flat.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    index = flat.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    bounds = offsets - offsets[0]
    if "" in names:  # white space at either end of a text
        real = index != names.index("")
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        index = index[real]
    w = mix(hashes)[index] if len(names) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(w) - words + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words):
            rolled += w[k : k + len(rolled)] * np.uint64(2 * (k + 1) ** 3 * 0x9E3779B1 + 1)
    rolled = mix(rolled)
    sets = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            sets.append(np.unique(rolled[lo : hi - words + 1]))
        elif hi > lo:
            sets.append(np.array([xxhash.xxh3_64_intdigest(w[lo:hi].tobytes(), seed=hi - lo)], dtype=np.uint64))
        else:
            sets.append(rolled[:0])
    return (np.concatenate(sets) if sets else rolled[:0]), np.array([len(s) for s in sets], dtype=np.int64)


def size_bounds(similarity: tuple[int, int], most: int) -> np.ndarray:
    """Upper ends of size classes; sets that link lie in one class or two adjacent ones."""
    num, den = similarity
    out = [1]
    while out[-1] < most:
        out.append(max(out[-1] + 1, out[-1] * den // num))
    out.append(max(out[-1] + 1, out[-1] * den // num))
    return np.array(out, dtype=np.int64)


def agreeing(allowed: np.ndarray, least_size: np.ndarray) -> np.ndarray:
    """K of each class: more than the empty buckets that its smallest sets are likely to have."""
    buckets = np.maximum(allowed + AGREE, 1)
    empty = buckets * np.exp(-least_size / buckets)
    return AGREE + np.ceil(empty + 2 * np.sqrt(empty)).astype(np.int64)


def signatures(sets: np.ndarray, n: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text's number): two sets that link and differ share at least one signature.

    In a class of sets up to U large, linked sets differ in at most H = floor(2U (1-t)/(1+t))
    shingles; of H + K buckets at least K agree. A bucket with shingles signs alone. Empty ones
    agree by chance, so K is chosen above the number that a set is likely to have: then one of
    the agreeing buckets holds shingles. A set of e >= K empty buckets signs the first
    e - K + 1 of them as well: if a pair agrees in K empty ones, the first of those is among
    them in both. Every set signs for its own class and the next, where it meets larger partners.
    """
    num, den = similarity
    ends = size_bounds(similarity, int(n.max(initial=1)))
    own = np.searchsorted(ends, n)
    doc_of = np.repeat(np.arange(len(n)), n)
    sigs, docs = [], []
    for shift in (0, 1):
        cls = own + shift
        allowed = 2 * ends[cls] * (den - num) // (den + num)
        least = agreeing(allowed, ends[cls] * num / den)
        m = np.where((allowed > 0) & (n > 0), allowed + least, 0)
        base = np.cumsum(m) - m
        total = int(m.sum())
        if not total:
            continue
        use = m[doc_of] > 0
        d, h = doc_of[use], sets[use]
        slot = base[d] + ((h >> np.uint64(16)) % m[d].astype(np.uint64)).astype(np.int64)
        with np.errstate(over="ignore"):
            sums = np.zeros(total, dtype=np.uint64)
            np.add.at(sums, slot, mix(h))
            doc = np.repeat(np.arange(len(n)), m)
            at = np.arange(total) - base[doc]
            place = mix((cls[doc].astype(np.uint64) << np.uint64(40)) + at.astype(np.uint64) + np.uint64(1))
            full = np.bincount(slot, minlength=total) > 0
            sigs.append(mix(sums + place)[full])
            docs.append(doc[full])
            empty = np.flatnonzero(~full)
            count = np.bincount(doc[empty], minlength=len(n))
            rank = np.arange(len(empty)) - (np.cumsum(count) - count)[doc[empty]]
            empty = empty[rank <= (count - least)[doc[empty]]]
            sigs.append(mix(place[empty] * np.uint64(3) + np.uint64(1)))
            docs.append(doc[empty])
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(sigs), np.concatenate(docs)


def _set_ids(sets: np.ndarray, n: np.ndarray) -> tuple[list[int], list[int]]:
    """128-bit fingerprints of the sets, as two signed 64-bit numbers; 0, 0 for an empty set."""
    a, b, lo = [], [], 0
    for k in n.tolist():
        f = xxhash.xxh3_128_intdigest(sets[lo : lo + k].tobytes()) if k else 0
        a.append((f >> 64) - (1 << 64) * (f >> 127))
        b.append((f & (1 << 64) - 1) - (1 << 64) * (f >> 63 & 1))
        lo += k
    return a, b


def sketch_widths(n: np.ndarray) -> np.ndarray:
    """Buckets of the sketches of sets of ``n`` shingles: 4 shingles at most fall into each, a power of two.

    Sets that are not alike then differ in most buckets, however large they are.
    """
    return np.clip(1 << np.ceil(np.log2(np.maximum(n, 1) / 4)).clip(0).astype(np.int64), MIN_SKETCH, MAX_SKETCH)


def sketches(sets: np.ndarray, n: np.ndarray) -> list[bytes]:
    """How many shingles of each set fall into each of its hash buckets, one byte a bucket, 255 at most."""
    width = sketch_widths(n)
    base = np.cumsum(width) - width
    doc = np.repeat(np.arange(len(n)), n)
    at = base[doc] + ((sets >> np.uint64(40)).astype(np.int64) & (width[doc] - 1))
    counts = np.minimum(np.bincount(at, minlength=int(width.sum())), 255).astype(np.uint8)
    return [counts[lo:hi].tobytes() for lo, hi in zip(base.tolist(), (base + width).tolist(), strict=True)]


def folded(counts: np.ndarray, width: int) -> np.ndarray:
    """Rows of counts as those of ``width`` buckets: a wider sketch's buckets add up to a narrower one's."""
    return counts if counts.shape[1] == width else counts.reshape(len(counts), -1, width).sum(axis=1, dtype=np.int64)


def texts_of(batch: pa.RecordBatch):
    """Blocks of a batch's packed texts, unpacked."""
    for part in opened(batch):
        yield from blocks(part, "text")


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """row, doc_id, n_shingles, the set's fingerprint (fa, fb) and sketch of every row (texts packed)."""

    def run(batches):
        for batch in batches:
            for block in texts_of(batch):
                sets, n = shingle_sets(block.column("text"), words)
                a, b = _set_ids(sets, n)
                yield pa.RecordBatch.from_arrays(
                    [block.column("row"), block.column("doc_id"), pa.array(n), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                     pa.array(sketches(sets, n), pa.binary())], ["row", "doc_id", "n_shingles", "fa", "fb", "sketch"])

    return docs.mapInArrow(trimmed(run), "row long, doc_id long, n_shingles long, fa long, fb long, sketch binary")


def cells(docs: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """(cell, members array<long>): the different lists of sets (fa) that share a signature.

    Near copies agree in most of their signatures, so the same list comes from many of them:
    once a task, and once in all after lists of one name, a 128-bit hash, are merged.
    """
    parts = shuffle_partitions(docs.sparkSession)

    def sign(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            sig, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            segment = (sig % np.uint64(parts)).astype(np.int32)
            # 48 bits beside the segment: chance agreements, which would tie unrelated regions
            # together, are a few in a thousand tasks of a million signatures.
            high, low = (sig >> np.uint64(32)).astype(np.uint32), (sig >> np.uint64(16)).astype(np.uint16)
            order = np.lexsort((ids, segment))  # a set's signatures side by side compress well
            cut = np.searchsorted(segment[order], np.arange(parts + 1))
            some = [s for s in range(parts) if cut[s] < cut[s + 1]]
            rows = [order[cut[s] : cut[s + 1]] for s in some]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), *[pa.array([x[r].tobytes() for r in rows], pa.binary()) for x in (high, low, ids)]],
                ["segment", "high", "low", "ids"])

        for batch in batches:
            for block in texts_of(batch):
                sets, n = shingle_sets(block.column("text"), words)
                a = np.array(_set_ids(sets, n)[0], dtype=np.int64)
                first = np.zeros(len(n), dtype=bool)
                first[np.unique(a, return_index=True)[1]] = True  # a set of this block signs once
                keep = np.repeat(first, n)
                sig, doc = signatures(sets[keep], n[first], similarity)
                held.append((sig, a[first][doc]))
                if sum(len(x) for x, _ in held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    def gather(batches):
        sigs, ids = [], []
        for b in batches:
            for x, y in zip(b.column("high"), b.column("low"), strict=True):
                low = np.frombuffer(y.as_buffer(), np.uint16)
                sigs.append(np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64) << np.uint64(16) | low)
            ids += [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("ids")]
        if not sigs:
            return
        sig, ident = np.concatenate(sigs), np.concatenate(ids)
        sigs.clear()
        ids.clear()
        order = np.lexsort((ident, sig))
        sig, ident = sig[order], ident[order]
        again = np.append(False, (sig[1:] == sig[:-1]) & (ident[1:] == ident[:-1]))
        sig, ident = sig[~again], ident[~again]
        starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        ends = np.append(starts[1:], len(sig))
        many = ends - starts > 1
        out: dict[bytes, np.ndarray] = {}
        seen = set()

        def lists():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.binary()), pa.array(list(out.values()), pa.list_(pa.int64()))], ["name", "members"])

        for lo, hi in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
            name = xxhash.xxh3_128_digest(ident[lo:hi].tobytes())
            if name not in seen:
                seen.add(name)
                out[name] = ident[lo:hi]
            if len(out) >= 10_000:
                yield lists()
                out = {}
        if out:
            yield lists()

    packed = docs.select("text").mapInArrow(trimmed(sign), "segment int, high binary, low binary, ids binary")
    found = packed.repartition(parts, "segment").mapInArrow(trimmed(gather), "name binary, members array<long>")
    return found.groupBy("name").agg(F.first("members").alias("members")).select(F.monotonically_increasing_id().alias("cell"), "members")


def _groups(sketch: list[np.ndarray], size: np.ndarray, similarity: tuple[int, int]) -> list[np.ndarray]:
    """Members of one cell that may link, directly or by others: groups of two or more.

    Two sets differ in at least as many shingles as their sketches' counts differ; a pair
    beyond what the threshold allows is no link. Every member looks only at those that no
    group holds yet, so that a cell of copies takes one look.
    """
    num, den = similarity
    width = np.array([len(x) for x in sketch])
    place, tables = np.zeros(len(size), dtype=np.int64), {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        place[own] = np.arange(len(own))
        tables[w] = np.stack([sketch[i] for i in own])

    def apart(v, others):
        out = np.empty(len(others), dtype=np.int64)
        for w, table in tables.items():
            of = np.flatnonzero(width[others] == w)
            if len(of):
                both = min(w, int(width[v]))
                a, b = folded(table[place[others[of]]], both), folded(sketch[v][None], both)
                out[of] = np.abs(a.astype(np.int64) - b.astype(np.int64)).sum(axis=1)
        return out

    free, out = np.arange(len(size)), []
    while len(free):
        group, todo, free = [], [free[0]], free[1:]
        while todo and len(free):
            v = todo.pop()
            group.append(v)
            both = size[free] + size[v]
            least = np.minimum(size[free], size[v])
            may = least * den >= (both - least) * num
            may[may] = apart(v, free[may]) * (den + num) <= both[may] * (den - num)
            todo += free[may].tolist()
            free = free[~may]
        group += todo
        if len(group) > 1:
            out.append(np.array(group))
    return out


def tile_edges(batches, similarity: tuple[int, int]):
    """Rows sorted by (cell, tile) -> batches (a, b) of the edges within each tile."""
    ids: list[int] = []
    size: list[int] = []
    sketch: list[np.ndarray] = []
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []

    def close():
        own = np.array(ids)
        for group in _groups(sketch, np.array(size), similarity):
            members = np.sort(own[group])
            a.append(np.full(len(members) - 1, members[0]))
            b.append(members[1:])
        for held in (ids, size, sketch):
            held.clear()

    def found():
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (a, b)], ["a", "b"])
        a.clear()
        b.clear()
        return out

    at = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "tile", "id", "n", "sketch")]
        for cell, tile, ident, n, counts in zip(*columns, strict=True):
            if at != (cell, tile):
                if ids:
                    close()
                at = (cell, tile)
            ids.append(ident)
            size.append(n)
            sketch.append(np.frombuffer(counts, np.uint8))
        yield found()
    if ids:
        close()
        yield found()


def tiles(cell: DataFrame) -> DataFrame:
    """(cell, tile, id): members of every cell, so that any two of one cell meet in some tile.

    Cells of up to CELL_ROWS members are one tile. Larger ones are dealt by hash over blocks of
    about that size, and every pair of blocks is a tile: a member goes to as many tiles as
    there are blocks.
    """
    blocks_of = F.ceil(F.size("members") / F.lit(CELL_ROWS)).cast("int").alias("blocks")
    inside = cell.select("cell", blocks_of, F.explode("members").alias("id"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1),
                      lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other))
    return inside.select("cell", "id", F.explode(met).alias("tile"))


def cell_edges(cell: DataFrame, rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(a, b): edges that connect, within each cell, the members that their sketches let link.

    Texts that share a passage meet in cells without being alike; without this step they
    would tie regions together as the corpus grows. No task holds more than a tile.
    """

    def run(batches):
        return tile_edges(batches, similarity)

    known = rows.where("n_shingles > 0").groupBy("fa").agg(F.min(F.struct("n_shingles", "sketch")).alias("s")).select(
        F.col("fa").alias("id"), F.col("s.n_shingles").alias("n"), "s.sketch")
    inside = tiles(cell).join(known.hint("merge"), "id")
    dealt = inside.repartition(shuffle_partitions(cell.sparkSession), "cell", "tile").sortWithinPartitions("cell", "tile")
    return dealt.select("cell", "tile", "id", "n", "sketch").mapInArrow(trimmed(run), "a long, b long").distinct()


def _inside(pivot: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which elements of the ascending ``own`` are in the ascending ``pivot``."""
    if not len(pivot):
        return np.zeros(len(own), dtype=bool)
    return pivot[np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)] == own


def _join_region(members: list[tuple[int, np.ndarray, int, int]], similarity: tuple[int, int]) -> list[tuple[int, int, int, int]]:
    """(a, b, inter, total) of links between members of one region that no other link joins.

    ``members``: (id, set, inter and total with the pivot). Far members are compared with
    those of other components whose size and distance to the pivot allow a link; a link
    found spares all other pairs of the two components.
    """
    num, den = similarity
    inter = np.array([m[2] for m in members])
    total = np.array([m[3] for m in members])
    near = inter * den >= total * num
    if near.all():
        return []
    d, size = 1 - inter / total, np.array([len(m[1]) for m in members])
    # Shingles as small numbers, so that one far set meets all members in one gather.
    shingles, code = np.unique(np.concatenate([m[1] for m in members]), return_inverse=True)
    code, starts = code.astype(np.int32), np.cumsum(size) - size
    comp = np.where(near, -1, np.arange(len(members)))
    held, out = np.zeros(len(shingles), dtype=bool), []
    for i in np.flatnonzero(~near).tolist():
        may = (
            (np.abs(d - d[i]) <= (den - num) / den + 1e-9)
            & (np.minimum(size, size[i]) * den >= np.maximum(size, size[i]) * num) & (comp != comp[i])
        )
        if not may.any():
            continue
        own = code[starts[i] : starts[i] + size[i]]
        held[own] = True
        both = np.add.reduceat(held[code], starts, dtype=np.int64)
        held[own] = False
        union = size + size[i] - both
        for j in np.flatnonzero(may & (both * den >= union * num)).tolist():
            if comp[j] != comp[i]:
                out.append((members[i][0], members[j][0], int(both[j]), int(union[j])))
                into, other = min(comp[i], comp[j]), max(comp[i], comp[j])
                comp[comp == other] = into
    return out


def measure(pairs: DataFrame, texts: DataFrame, words: int, similarity: tuple[int, int] | None = None) -> DataFrame:
    """(p, x, inter, total): sizes of intersection and union of the sets p and x.

    ``texts`` (set, n, text as zstandard frames) is joined to the distinct pairs' ends, by shuffle at
    any size, and unpacked where it is measured. The pairs of one p are dealt over parts of about PART_ROWS or PART_SHINGLES, each with p's text first: a part
    streams past its p. With ``similarity``, p is the pivot of a region: a region of one
    part is joined there and then (its further links are rows of their own), and of larger
    ones every row also has size (of x) and prefix: the first shingles of x in the order of
    the region, as many as any partner may ask for. That order puts shingles that p has not
    before those that it has, and goes by hash within the two. Elsewhere prefix is NULL.
    """
    sized = pairs.join(texts.select(F.col("set").alias("x"), "n"), "x")
    parts = sized.groupBy("p").agg(F.ceil(F.greatest(
        F.count("*") / F.lit(PART_ROWS), F.sum("n") / F.lit(PART_SHINGLES))).cast("int").alias("parts"))
    pairs = pairs.join(parts, "p").withColumn("part", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int"))
    texts = texts.hint("merge")
    heads = parts.select("p", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(
        texts.select(F.col("set").alias("p"), "text"), "p").select(
        "p", "part", "parts", F.lit(0).alias("kind"), F.col("p").alias("x"), "text")
    tails = pairs.join(texts.select(F.col("set").alias("x"), "text"), "x").select(
        "p", "part", "parts", F.lit(1).alias("kind"), "x", "text")
    names = ["p", "x", "inter", "total", "size", "prefix"]

    def batch_of(rows):
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.list_(pa.int64()))], names)

    def run(batches):
        at, pivot, held = None, None, []

        def joined():
            rows = [(*link, 0, None) for link in _join_region(held, similarity)]
            held.clear()
            return rows

        for batch in batches:
            for block in texts_of(batch):
                sets, n = shingle_sets(block.column("text"), words)
                ends = np.cumsum(n).tolist()
                out = []
                lo = 0
                rows = zip(*[block.column(c).to_pylist() for c in ("p", "part", "parts", "kind", "x")], ends, strict=True)
                for p, part, parts, kind, x, hi in rows:
                    own = sets[lo:hi]
                    lo = hi
                    if kind == 0:
                        if held:
                            out += joined()
                        at, pivot = (p, part), own.copy()
                    elif at == (p, part):
                        common = _inside(pivot, own)
                        inter = int(common.sum())
                        total, prefix = len(pivot) + len(own) - inter, None
                        if similarity and parts == 1:
                            held.append((x, own.copy(), inter, total))
                        elif similarity:
                            num, den = similarity
                            most = len(own) + num * len(own) // -den + 1  # len - ceil(len * num / den) + 1
                            prefix = np.concatenate([own[~common], own[common]])[:most].view(np.int64)
                        out.append((p, x, inter, total, len(own), prefix))
                yield batch_of(out)
        if held:
            yield batch_of(joined())

    columns = ["p", "part", "parts", "kind", "x", "text"]
    both = heads.select(*columns).unionByName(tails.select(*columns)).repartition("p", "part")
    found = both.sortWithinPartitions("p", "part", "kind", "x").mapInArrow(trimmed(run), "p long, x long, inter long, total long, size long, prefix array<long>")
    return found if similarity else found.select("p", "x", "inter", "total")


def jaccard_links(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY,
                  doc_id: str = "doc_id", text: str = "text", numbered: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, links): every row's doc_id, n_shingles and set (fa, fb); (a, b) of sets joined exactly.

    Links hold every pair of different sets whose similarity reaches the threshold, but for
    pairs that other links already join: their components are those of all links. Rows are
    numbered once, in a staged table of packed texts, and known by that number alone: ids may
    be NULL or tied. ``numbered``: ``docs`` is such a table, its ids are unique and its texts packed or NULL.
    """
    spark = docs.sparkSession
    ship_package(spark)
    num, den = similarity
    if numbered:
        packed = docs.select(F.col(doc_id).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    else:
        packed = stage(zipped(docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
            F.coalesce(F.col(text), F.lit("")).alias("text"))), "numbered")
    rows = stage(fingerprints(packed, words), "fingerprints")
    cell = stage(cells(packed, words, similarity), "cells")
    star = cell_edges(cell, rows, similarity)
    region = stage(connected_components(star), "regions")
    # One row of each set stands for it.
    members = stage(rows.where("n_shingles > 0").groupBy("fa").agg(F.min(F.struct("row", "n_shingles")).alias("d")).join(
        region.withColumnRenamed("id", "fa"), "fa").select(F.col("d.row").alias("at"), F.col("d.n_shingles").alias("n"), F.col("fa").alias("set")), "members")
    texts = stage(packed.join(checked_broadcast(members), F.col("row") == F.col("at")).select("set", "n", "text"), "texts")
    # The pivot of a region is the member that shares most cells: copies lie around what they copy.
    shared = cell.select(F.explode("members").alias("id")).groupBy("id").agg(F.count("*").alias("cells"))
    pivots = region.join(shared, "id").groupBy("root").agg(F.max(F.struct("cells", "id"))["id"].alias("pivot"))
    placed = stage(region.join(pivots, "root").select("id", "pivot"), "pivots")
    # First every member against its pivot.
    to_pivot = placed.where("id != pivot").select(F.col("pivot").alias("p"), F.col("id").alias("x"))
    near = stage(measure(to_pivot, texts, words, similarity), "distances")
    close = F.col("inter") * den >= F.col("total") * num
    linked = near.where(close).select(F.col("p").alias("a"), F.col("x").alias("b"))
    # (Regions of one part are joined already: their rows have no prefix.)
    large = near.where("prefix IS NOT NULL")
    if large.isEmpty():
        return rows, linked
    # Large regions go on in the same way: the far members get pivots of their own.
    state = stage(large.select(F.col("p").alias("region"), F.col("x").alias("id"), F.when(close, F.col("p")).alias("comp")), "regions")
    for _ in range(PIVOT_ROUNDS):
        far = state.where("comp IS NULL")
        new = stage(far.join(shared, "id").groupBy("region").agg(F.max(F.struct("cells", "id"))["id"].alias("pivot")), "pivots")
        to_pivot = far.join(new, "region").where("id != pivot").select(F.col("pivot").alias("p"), F.col("id").alias("x"))
        got = stage(measure(to_pivot, texts, words), "distances").where(close).select(F.col("p").alias("a"), F.col("x").alias("b"))
        linked = linked.unionByName(got)
        found = got.select(F.col("b").alias("id"), F.col("a").alias("to")).unionByName(
            new.select(F.col("pivot").alias("id"), F.col("pivot").alias("to")))
        state = stage(state.join(found, "id", "left").select("region", "id", F.coalesce("comp", "to").alias("comp")), "regions")
    # What is left are pairs of members of different pivots, or of none. By the triangle
    # inequality their distances to the region's pivot differ by the radius at most; and two
    # sets that share enough share one of the first shingles of both, in any common order. In
    # the region's order a far set's first ones lie outside the pivot, where copies differ.
    marked = large.join(state.select(F.col("id").alias("x"), F.coalesce("comp", "id").alias("comp")), "x").select(
        "p", "x", "comp", "size", (1 - F.col("inter") / F.col("total")).alias("d"), F.posexplode("prefix").alias("pos", "g"))
    marked = stage(marked, "prefixes")
    torn = marked.groupBy("p", "g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("p", "g")
    marked = stage(marked.join(torn, ["p", "g"]), "torn")
    left = marked.where("comp != p").select("p", "g", *[F.col(c).alias(f"{c}_a") for c in ("x", "comp", "size", "d", "pos")])
    right = marked.select(*[F.col(c).alias(f"{c}_b") for c in ("p", "g", "x", "comp", "size", "d", "pos")])
    need = F.ceil(F.lit(num) * (F.col("size_a") + F.col("size_b")) / F.lit(num + den))  # shingles in common, at least
    fits = (
        (F.col("comp_a") != F.col("comp_b")) & ((F.col("x_a") < F.col("x_b")) | (F.col("comp_b") == F.col("p_b")))
        & (F.col("pos_a") <= F.col("size_a") - need) & (F.col("pos_b") <= F.col("size_b") - need)
        & (F.least("size_a", "size_b") * den >= F.greatest("size_a", "size_b") * num)
        & (F.abs(F.col("d_a") - F.col("d_b")) <= (den - num) / den + 1e-9)
    )
    keys = (F.col("p") == F.col("p_b")) & (F.col("g") == F.col("g_b"))
    rest = left.join(right, keys & fits).select(F.col("x_a").alias("p"), F.col("x_b").alias("x")).distinct()
    more = measure(stage(rest, "pairs"), texts, words).where(close).select(F.col("p").alias("a"), F.col("x").alias("b"))
    return rows, linked.unionByName(more)


def jaccard_components(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY,
                       doc_id: str = "doc_id", text: str = "text", numbered: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row.

    Rows without words, empty or NULL texts link with nothing. Equal sets link. NULL ids
    are never a component's id unless the row stands alone. Repeated rows stay. ``numbered``
    as for ``jaccard_links``.
    """
    rows, links = jaccard_links(docs, words, similarity, doc_id, text, numbered)
    roots = stage(connected_components(links), "roots")
    placed = rows.join(roots.withColumnRenamed("id", "fa"), "fa", "left")
    key = F.when(F.col("n_shingles") > 0, F.struct(
        F.coalesce("root", "fa").alias("r"), F.when(F.col("root").isNull(), F.col("fb")).alias("fb")))
    placed = stage(placed.select("doc_id", "n_shingles", key["r"].alias("r"), F.coalesce(key["fb"], F.lit(0)).alias("fb")), "placed")
    least = placed.where("r IS NOT NULL").groupBy("r", "fb").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, ["r", "fb"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
