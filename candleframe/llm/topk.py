"""Exact top-k search: exhaustive term-at-a-time accumulation over blocks of sparse vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candleframe.llm.common import ship_package, stage

#: Rows of one block of queries, and of one block of candidates. A task holds one of each.
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
#: Candidates that are scored at a time: their scores and one posting list stay in cache.
STRIPE = 4096


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def _matrix(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of all non-zero components."""
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    keep = flat != 0
    return row[keep], term[keep], flat[keep]


def _largest(weights: np.ndarray) -> int:
    """The largest absolute value, as a Python integer: products of two may exceed 64 bits."""
    return max(int(weights.max()), -int(weights.min())) if len(weights) else 0


def top_of_block(queries: pa.ListArray, candidates: pa.ListArray, ids: np.ndarray, own: np.ndarray, k: int):
    """(query row, candidate row, score) of every query's k best candidates of one block.

    Candidates become one posting list per term (rows ascending, with weights). A query row
    scatters each of its weights over that term's postings into a dense array of scores;
    a partition then selects the k best. ``ids`` ascend, so that ties go to the smaller id;
    a query never finds its own id (``own``). A score among the best that exceeds a long
    raises OverflowError.
    """
    qrow, qterm, qweight = _matrix(queries)
    crow, cterm, cweight = _matrix(candidates)
    m, n = len(queries), len(candidates)
    terms = int(max(qterm.max(initial=-1), cterm.max(initial=-1))) + 1
    # Sums of absolute products bound every score: 32 bits where that is enough, else 64, else Python integers.
    most = _largest(qweight) * _largest(cweight) * max(terms, 1)
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    number = int if kind is object else kind
    starts = np.searchsorted(qrow, np.arange(m + 1))
    copies = np.searchsorted(ids, own, "right") - np.searchsorted(ids, own, "left")
    best: list[list] = [[] for _ in range(m)]
    for lo in range(0, n, STRIPE):
        hi = min(lo + STRIPE, n)
        inside = (crow >= lo) & (crow < hi)
        order = np.argsort(cterm[inside], kind="stable")
        rows, t = crow[inside][order] - lo, cterm[inside][order]
        weights = cweight[inside][order].astype(kind)
        cut = np.searchsorted(t, np.arange(terms + 1))
        width = hi - lo
        postings = []
        for j in range(terms):
            r, w = rows[cut[j] : cut[j + 1]], weights[cut[j] : cut[j + 1]]
            if 2 * len(r) > width:  # a list that names most rows: kept with its zeros, scattered without row numbers
                dense = np.zeros(width, dtype=kind)
                dense[r] = w
                r, w = None, dense
            postings.append((r, w))
        scores, product = np.empty(width, dtype=kind), np.empty(width, dtype=kind)
        for q in range(m):
            scores[:] = 0
            for p in range(starts[q], starts[q + 1]):
                r, w = postings[qterm[p]]
                if r is None:
                    np.multiply(w, number(qweight[p]), out=product)
                    np.add(scores, product, out=scores)
                elif len(r):
                    scores[r] += w * number(qweight[p])
            # The k best, as many more as rows may have the query's own id, and all that tie with the last.
            want = min(k + int(copies[q]), width)
            least = np.partition(scores, width - want)[width - want]
            found = np.flatnonzero(scores >= least)
            found = found[ids[found + lo] != own[q]]
            found = found[np.lexsort((found, -scores[found].astype(np.int64)))][:k]
            best[q].append((found + lo, scores[found].astype(np.int64)))
    out_q, out_c, out_s = [], [], []
    for q, parts in enumerate(best):
        c = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        s = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        pick = np.lexsort((c, -s))[:k]
        out_q.append(np.full(len(pick), q))
        out_c.append(c[pick])
        out_s.append(s[pick])
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_c, out_s))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Exact k best rows by inner product of quantised vectors: query_id, rank, vec_id, score.

    Components become floor(scale * x); zeros are left out of the sparse rows. Queries are
    the rows where ``is_query`` holds; candidates are all rows but those with the query's
    own id. Equal scores rank by smaller id. Rows with a NULL id, a NULL vector or NULL or
    non-finite components take no part; vectors may differ in length (absent terms are 0).
    Repeated rows are candidates each, and each repeated query row is answered (its ranks
    once more); no queries or no candidates: no rows.

    Queries and candidates are dealt into blocks by hash; every pair of blocks is one group
    of at most about QUERY_BLOCK + CANDIDATE_BLOCK rows, found by an equality join on the
    block's number: a stated query set against all rows, never rows against rows. Each
    group returns k rows a query, which a window cut before the shuffle merges.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    v = F.col(vector)
    ready = stage(
        vectors.where(F.col(vec_id).isNotNull() & usable(v)).select(
            F.col(vec_id).cast("long").alias("id"), quantised(v, scale).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
        ), "vectors")
    n, nq = ready.agg(F.count("*"), F.count(F.when(F.col("q"), 1))).first()
    cands, asks = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-nq // QUERY_BLOCK))
    numbered = ready.select(
        "id", "v", "q", F.pmod(F.xxhash64("id", F.lit("c")), F.lit(cands)).cast("int").alias("c"))
    queries = ready.where("q").withColumn("uid", F.monotonically_increasing_id())
    queries = queries.select(
        "id", "v", "uid", F.pmod(F.xxhash64("id", F.lit("q")), F.lit(asks)).cast("int").alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(cands - 1))).alias("c"))
    rows = numbered.select("id", "v", F.lit(None).cast("long").alias("uid"), "c", F.explode(F.sequence(F.lit(0), F.lit(asks - 1))).alias("b"))

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.sort_by("id").combine_chunks()
        ids, own = right.column("id").to_numpy(), left.column("id").to_numpy()

        def lists(t):
            return t.column("v").chunk(0) if t.num_rows else pa.array([], pa.list_(pa.int64()))

        q, c, s = top_of_block(lists(left), lists(right), ids, own, k) if len(ids) and len(own) else ([], [], [])
        q, c = np.asarray(q, dtype=np.int64), np.asarray(c, dtype=np.int64)
        uid = left.column("uid").to_numpy()
        return pa.table({"uid": pa.array(uid[q], pa.int64()), "query_id": pa.array(own[q], pa.int64()),
                         "vec_id": pa.array(ids[c], pa.int64()), "score": pa.array(s, pa.int64())})

    found = queries.groupBy("c", "b").cogroup(rows.groupBy("c", "b")).applyInArrow(
        score, "uid long, query_id long, vec_id long, score long")
    w = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
