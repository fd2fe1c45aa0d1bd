"""Sharding by balanced label propagation: linked documents gather, shard sizes stay even."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleframe.llm.common import gapless_rank, stage

SHARDS = 24


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def grant(requests: dict[tuple[int, int, int], int], held: list[int], quota: list[int]) -> dict[tuple[int, int, int], int]:
    """How many of the moves (from, to, bucket) may go ahead so that no shard exceeds its quota.

    Larger buckets first; a move frees room for others, so passes repeat until none is
    granted; two full shards may still exchange documents. ``held`` is updated.
    """
    left, given = dict(requests), dict.fromkeys(requests, 0)
    order = sorted(left, key=lambda r: (-r[2], r))
    between: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for r in order:
        between.setdefault(r[:2], []).append(r)
    moved = True
    while moved:
        moved = False
        for r in order:
            a = min(left[r], quota[r[1]] - held[r[1]])
            if a > 0:
                left[r] -= a
                given[r] += a
                held[r[0]] -= a
                held[r[1]] += a
                moved = True
        for r in order:
            for back in between.get((r[1], r[0]), []):
                if left[r] and left[back]:
                    a = min(left[r], left[back])
                    for x in (r, back):
                        left[x] -= a
                        given[x] += a
                    moved = True
    return given


def propagate(links: DataFrame, quota: list[int], rounds: int | None = None) -> DataFrame:
    """Shards of the linked documents: uid, shard.

    ``links`` (uid, link; staged): documents with one ``link`` are linked with each other; a
    document may have several. They start evenly dealt. In each round every link elects the
    shard that holds most of its members (ties by a hash of link, shard and round), and where
    that cannot take all of them the next ones too, until they can; a document elsewhere asks
    to move to a shard elected by its largest link, if that holds more of the link than its
    own. Rounds take turns: in one, shards with room are elected, in the next full ones too,
    whose documents may be exchanged. The driver sees only counts by (from, to, size
    bucket), at most shards^2 * 40 rows, and grants moves within the quotas, large links first.

    It ends when two rounds in a row bring no pair of linked documents together on balance
    (with one link a document, when none moves), or after ``rounds``.
    """
    shards = len(quota)
    members = stage(links.groupBy("uid").agg(F.min("link").alias("link")), "members")
    n = members.count()
    dealt = gapless_rank(members.select("uid", F.lit(0).alias("all")), ["all"], ["uid"], "r", max(1, n))
    state = stage(dealt.select("uid", (F.col("r") % shards).cast("int").alias("shard")), "shards")
    held = [n // shards + (s < n % shards) for s in range(shards)]
    best, idle, number = -1, 0, 0
    while idle < 2 and (rounds is None or number < rounds):
        exchange = number % 2 == 1
        number += 1
        room = F.array(*[F.lit(q if exchange else q - h).cast("long") for q, h in zip(quota, held, strict=True)])
        placed = links.join(state, "uid")
        counts = stage(placed.groupBy("link", "shard").agg(F.count("*").alias("n")), "counts")
        together = counts.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
        idle = 0 if together > best else idle + 1
        best = max(best, together)
        if idle == 2:
            break
        # What a shard can hold of a link: its members there, and the room (or all others, exchanged).
        free = F.greatest(F.get(room, F.col("shard")) - F.when(F.lit(exchange), F.col("n")).otherwise(F.lit(0)), F.lit(0))
        score = F.struct("n", F.xxhash64(F.lit(number), "link", "shard").alias("tie"), "shard")
        scored = counts.select("link", "n", score.alias("score"), free.cast("long").alias("room"))
        whole = Window.partitionBy("link")
        ahead = whole.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
        elected = (
            scored.withColumn("size", F.sum("n").over(whole))
            .withColumn("taken", F.coalesce(F.sum(F.col("n") + F.col("room")).over(ahead), F.lit(0)))
            .withColumn("start", F.coalesce(F.sum("room").over(ahead), F.lit(0)))
            .where("taken < size")
            .groupBy("link").agg(
                F.collect_list(F.when(F.col("room") > 0, F.struct("start", "room", "score"))).alias("open"),
                F.sum("room").alias("rooms"), F.collect_list("score.shard").alias("ours"))
            .where("rooms > 0")
        )
        at = counts.select("link", "shard", score.alias("own"))
        x = F.pmod(F.xxhash64(F.lit(number), "uid"), F.col("rooms"))
        to = F.get(F.filter("open", lambda o: (o["start"] <= x) & (x < o["start"] + o["room"])), F.lit(0))["score"]
        wish = placed.join(elected, "link").join(at, ["link", "shard"]).select("uid", "shard", "ours", "own", to.alias("to")).select(
            "uid", F.when(~F.array_contains("ours", F.col("shard")) & (F.col("to") > F.col("own")),
                          F.struct(F.col("to.n").alias("n"), F.col("to.shard").alias("to"))).alias("wish"),
        ).groupBy("uid").agg(F.max("wish").alias("wish"))
        wish = stage(state.join(wish, "uid", "left").select(
            "uid", "shard", F.col("wish.to").alias("to"), F.floor(F.log2(F.col("wish.n"))).cast("int").alias("bucket"),
        ), "wishes")
        asked = wish.where("to IS NOT NULL").groupBy("shard", "to", "bucket").agg(F.count("*").alias("n")).collect()
        requests = {(r["shard"], r["to"], r["bucket"]): r["n"] for r in asked}
        given = grant(requests, held, quota)
        if not sum(given.values()):
            continue
        # Grants as a table of at most shards^2 * 40 rows: all, some or none of each cell move.
        cell = ["shard", "to", "bucket"]
        grants = F.broadcast(links.sparkSession.createDataFrame(
            [(*r, given[r], requests[r]) for r in requests], "shard int, to int, bucket int, given long, asked long"))
        told = wish.join(grants, cell, "left")
        some = (F.col("given") > 0) & (F.col("given") < F.col("asked"))
        state = told.where(~F.coalesce(some, F.lit(False))).select(
            "uid", F.when(F.col("given") > 0, F.col("to")).otherwise(F.col("shard")).alias("shard"))
        if any(0 < given[r] < requests[r] for r in requests):
            ranked = gapless_rank(told.where(some), cell, ["uid"], "r", n)
            state = state.unionByName(ranked.select(
                "uid", F.when(F.col("r") < F.col("given"), F.col("to")).otherwise(F.col("shard")).alias("shard")))
        state = stage(state, "shards")
    return state


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its size, shard and slot: counts at most one apart, equal texts together.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, group_rows (documents
    with this text), shard and slot (0, 1, ... within the shard). Documents with equal texts
    are linked, and gather by label propagation as far as the shards' quotas allow;
    documents without a copy then fill what room is left. NULL text has no bytes and equals
    no other; empty texts equal each other. Rows with one id are told apart by their place
    in a staged table. An empty table gives no rows; other columns are not carried.

    Texts are read once, to a slim staged table; no step collects rows, and every rank is
    taken in salted groups.
    """
    t = F.col(text)
    full = F.coalesce(t, F.lit(""))
    slim = stage(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"),
        (F.octet_length(full) + 8).cast("long").alias("size"), F.crc32(full.cast("binary")).alias("text_crc32"),
        F.when(t.isNotNull(), F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))).alias("link"),
    ), "sizes")
    n = slim.count()
    quota = quotas(n, shards)
    groups = slim.where("link IS NOT NULL").groupBy("link").agg(F.count("*").alias("group_rows")).where("group_rows > 1")
    linked = stage(slim.join(groups, "link").select("uid", "doc_id", "size", "text_crc32", "link", "group_rows"), "linked")
    state = propagate(linked.select("uid", "link"), quota, rounds)
    placed = linked.drop("link").join(state, "uid")
    placed = gapless_rank(stage(placed, "placed"), ["shard"], ["uid"], "slot", max(1, n))
    taken = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    ends = list(accumulate(q - taken.get(s, 0) for s, q in enumerate(quota)))
    rest = stage(slim.join(groups, "link", "left").where("group_rows IS NULL").select(
        "uid", "doc_id", "size", "text_crc32", F.lit(1).cast("long").alias("group_rows"), F.lit(0).alias("all")), "rest")
    ranked = gapless_rank(rest, ["all"], ["uid"], "r", max(1, n))
    edges = F.array(*[F.lit(e).cast("long") for e in ends])
    shard = F.size(F.filter(edges, lambda e: e <= F.col("r")))
    before = F.array(*[F.lit(e - (q - taken.get(s, 0)) - taken.get(s, 0)).cast("long") for s, (e, q) in enumerate(zip(ends, quota, strict=True))])
    filled = ranked.withColumn("shard", shard).withColumn("slot", F.col("r") - F.get(before, F.col("shard")))
    cols = ["doc_id", "size", "text_crc32", "group_rows", "shard", "slot"]
    return placed.select(*cols).unionByName(filled.select(*cols))
