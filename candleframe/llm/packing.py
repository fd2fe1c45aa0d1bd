"""Best-fit packing of token pieces by a configuration linear program over their lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleframe.llm.common import ddl, gapless_rank, ship_package, stage, trimmed
from candleframe.llm.token_files import encode_rows

CAPACITY = 4096
#: The program is solved when no fractional plan can be better by this share.
GAP = 0.0005
#: Knapsacks that are priced at most, and steps of multiplicative weights between two of them.
ROUNDS, STEPS = 400, 4000
#: Steps of the weights' exponent: the next one where the one before finds no better configuration.
EPSILONS = (0.3, 0.1, 0.03)
#: Lengths up to which a pool of configurations is weighed again between two knapsacks.
FEW = 64
#: Shares of the capacity that may stay free where a configuration's items run out; the best plan of all is taken.
SPARE = (None, 0.02, 0.1)
#: Rounds without a better rounded plan after which a program over many lengths ends.
PATIENCE = 100


def price(weights: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable multiset of lengths that fits: unbounded knapsack, by dynamic program.

    ``weights[l]`` is the value of one item of length l (-inf: there is none). Returns how
    often each length is taken.
    """
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)
    w = weights[1:]
    for c in range(1, capacity + 1):
        value = best[c - 1 :: -1] + w[:c]  # best[c - l] + w[l], for l = 1 .. c
        length = int(value.argmax())
        if value[length] > best[c - 1]:
            best[c], choice[c] = value[length], length + 1
        else:
            best[c] = best[c - 1]
    take, c = np.zeros(capacity + 1, dtype=np.int64), capacity
    while c > 0:
        if choice[c]:
            take[choice[c]] += 1
            c -= choice[c]
        else:
            c -= 1
    return take


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing patterns that hold every item exactly once, each repeated while its items last."""
    left = counts.copy()
    out: list[tuple[dict[int, int], int]] = []
    have = [int(k) for k in np.flatnonzero(left)]
    while have:
        room, pattern = capacity, {}
        i = len(have) - 1
        while i >= 0:
            k = have[i]
            n = min(int(left[k]), room // k)
            if n:
                pattern[k] = n
                room -= n * k
            i = min(i, bisect_right(have, room)) - 1
        m = min(int(left[k]) // n for k, n in pattern.items())
        out.append((pattern, m))
        for k, n in pattern.items():
            left[k] -= m * n
            if not left[k]:
                have.remove(k)
    return out


def size_of(plan: list[tuple[dict[int, int], int]]) -> int:
    return sum(m for _, m in plan)


def _weigh(pool: np.ndarray, counts: np.ndarray, weights: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(how often each configuration of the pool, weights) by multiplicative weights; every length is covered.

    Each step takes the best-valued configuration as often as its scarcest length allows; the
    weights of what it covers shrink. Of all steps, the weights with the best bound return.
    """
    share = pool / counts  # of each length's items, in one such configuration
    step = 1 / share.max(axis=1)
    x, cover = np.zeros(len(pool)), np.zeros(len(counts))
    best, kept = 0.0, weights
    values = pool @ weights
    for _ in range(STEPS):
        top = int(values.argmax())
        bound = float(counts @ weights) / values[top]
        if bound > best:
            best, kept = bound, weights.copy()
        x[top] += step[top]
        cover += step[top] * share[top]
        weights = weights * np.exp(-epsilon * step[top] * share[top])
        weights /= weights.max()
        values = pool @ weights
    least = cover.min()
    return (x / least if least > 0 else np.full(len(pool), np.inf)), kept


def pooled(counts: np.ndarray, capacity: int, rounds: int, start: list[dict[int, int]]):
    """(configurations with how often, lower bound) of the covering program over configurations.

    The program: use configurations so that every length is covered ``counts`` times, with as
    few as possible. Multiplicative weights solve it over a pool of configurations; their
    weights are a dual, for which a knapsack dynamic program finds the best configuration of
    all. It joins the pool, and its value turns the weights into a lower bound. That goes on
    until the two meet within GAP, or no step width gives a better configuration.
    """
    lengths = np.flatnonzero(counts)
    n = counts[lengths].astype(float)
    pool = [np.where(lengths == k, capacity // k, 0) for k in lengths]
    pool += [np.array([p.get(int(k), 0) for k in lengths]) for p in start]
    pool = np.unique(np.array(pool, dtype=float), axis=0)
    weights = lengths / capacity  # the dual of the size bound
    bound, best, x, at = float(n @ weights), np.inf, None, 0
    used = pool
    for _ in range(rounds):
        found, weights = _weigh(pool, n, weights, EPSILONS[at])
        if found.sum() < best:
            best, x, used = float(found.sum()), found, pool
        full = np.full(capacity + 1, -np.inf)
        full[lengths] = weights
        take = price(full, capacity)[lengths].astype(float)
        value = float(take @ weights)
        bound = max(bound, float(n @ weights) / value)
        if best <= (1 + GAP) * bound:
            break
        if value > (pool @ weights).max() * (1 + 1e-9):
            pool = np.concatenate([pool, take[None]])
        elif at + 1 < len(EPSILONS):
            at += 1
        else:
            break
    plan = [({int(k): int(c) for k, c in zip(lengths, t, strict=True) if c}, float(v)) for t, v in zip(used, x, strict=True) if v > 0] if x is not None else []
    return plan, bound


def swept(counts: np.ndarray, capacity: int, rounds: int):
    """As ``pooled``, for many lengths: (configurations with how often, lower bound) after every 25 rounds.

    Each round prices one configuration and takes it as often as its scarcest length allows;
    weights start at the lengths, the dual of the size bound. Shares are scaled to the
    items' whole size, so that they cover nearly all of them; the rounding fills the rest.
    """
    lengths = np.arange(capacity + 1)
    weights = np.where(counts > 0, lengths.astype(float), -np.inf)
    size, bound, total = float((counts * lengths).sum()), 0.0, 0.0
    found: dict[bytes, list] = {}
    for i in range(1, rounds + 1):
        take = price(weights, capacity)
        used = take > 0
        bound = max(bound, float(counts[counts > 0] @ weights[counts > 0]) / float(take[used] @ weights[used]))
        step = float((counts[used] / take[used]).min())
        found.setdefault(take.tobytes(), [take, 0.0])[1] += step
        total += step * float((take * lengths).sum())
        weights[used] *= np.exp(-0.25 * take[used] * step / counts[used])
        if not i % 25:
            yield [({int(k): int(t[k]) for k in np.flatnonzero(t)}, x * size / total) for t, x in found.values()], bound


def filled(pattern: dict[int, int], room: int, left: np.ndarray, have: list[int]) -> dict[int, int]:
    """``pattern`` with further items of the sorted lengths ``have`` in its room, the longest that fit first."""
    out = dict(pattern)
    i = bisect_right(have, room) - 1
    while i >= 0 and room:
        k = have[i]
        n = min(int(left[k]) - out.get(k, 0), room // k)
        if n > 0:
            out[k] = out.get(k, 0) + n
            room -= n * k
        i = min(i, bisect_right(have, room)) - 1
    return out


def rounded(counts: np.ndarray, capacity: int, solution: list[tuple[dict[int, int], float]], spare: float | None) -> list[tuple[dict[int, int], int]]:
    """Whole configurations that hold every item exactly once.

    The fullest configurations first, each as often as its share rounded down. Where a length
    runs out (the program may cover it more than once), other items fill its place, unless
    more than ``spare`` of the capacity stays free. With ``spare`` None shares are rounded up, and
    a configuration ends where a length runs out. What is left goes by best-fit decreasing.
    """
    left = counts.copy()
    have = [int(k) for k in np.flatnonzero(left)]
    out: list[tuple[dict[int, int], int]] = []
    for take, x in sorted(solution, key=lambda s: (capacity - sum(k * c for k, c in s[0].items()), -s[1])):
        m = int(x + 1e-9) if spare is not None else int(np.ceil(x - 1e-9))
        free = capacity - sum(k * c for k, c in take.items())
        while m > 0:
            now = {k: min(c, int(left[k])) for k, c in take.items() if left[k]}
            if now != take and spare is None:
                break
            if now != take:
                now = filled(now, capacity - sum(k * c for k, c in now.items()), left, have)
                if capacity - sum(k * c for k, c in now.items()) > max(free, spare * capacity):
                    break
            if not now:
                break
            times = min(m, *(int(left[k]) // c for k, c in now.items()))
            out.append((now, times))
            m -= times
            for k, c in now.items():
                left[k] -= times * c
                if not left[k]:
                    have.remove(k)
    return out + best_fit(left, capacity)


def configurations(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], int]], int]:
    """(configurations with how often, lower bound): the best of best-fit decreasing and the rounded program.

    Where best-fit decreasing meets the size bound it cannot be beaten, and nothing is solved.
    """
    best = best_fit(counts, capacity)
    total = int((counts * np.arange(capacity + 1)).sum())
    least = -(-total // capacity)
    if size_of(best) == least or not rounds:
        return best, least
    if np.count_nonzero(counts) <= FEW:
        solution, bound = pooled(counts, capacity, rounds, [p for p, _ in best])
        plans = [best, *(rounded(counts, capacity, solution, spare) for spare in SPARE)]
        return min(plans, key=size_of), max(least, int(np.ceil(bound - 1e-6)))
    idle = 0
    for solution, bound in swept(counts, capacity, rounds):
        least = max(least, int(np.ceil(bound - 1e-6)))
        plan = min((rounded(counts, capacity, solution, spare) for spare in SPARE), key=size_of)
        idle = 0 if size_of(plan) < size_of(best) else idle + 25
        best = min(best, plan, key=size_of)
        if size_of(best) <= (1 + GAP) * least or idle >= PATIENCE:
            break
    return best, least


@dataclass
class Plan:
    """Where the s-th piece of each length goes: rows sorted by (length, first slot)."""

    key: np.ndarray
    first_sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequences: int

    SHIFT = 48

    def place(self, length: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.key, (length << self.SHIFT) + slot, side="right") - 1
        k = slot - (self.key[row] & ((1 << self.SHIFT) - 1))
        return self.first_sequence[row] + k // self.copies[row], self.offset[row] + k % self.copies[row] * length


def make_plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """``counts[l]``: pieces of length l. Its size depends on ``capacity`` and ``rounds`` alone."""
    configs, _ = configurations(counts, capacity, rounds)
    used = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    for pattern, m in configs:
        at = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append(((length << Plan.SHIFT) + int(used[length]), sequence, n, at))
            used[length] += m * n
            at += n * length
        sequence += m
    a = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return Plan(a[:, 0].copy(), a[:, 1].copy(), a[:, 2].copy(), a[:, 3].copy(), sequence)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces of ``capacity`` tokens."""
    ship_package(docs.sparkSession)

    def cut(batches):
        for doc_ids, ids, ends in encode_rows(batches, tokenizer):
            raw = memoryview(ids.tobytes())
            n = np.diff(ends, prepend=0)
            pieces = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(n[doc] - start, capacity)
            at = (ends - n)[doc] + start
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_ids[i] for i in doc.tolist()], pa.int64()), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(trimmed(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS, order: list[str] | None = None) -> DataFrame:
    """``pieces`` (staged, with a column ``length`` of 1 to ``capacity``) with sequence_id and offset.

    Only the length histogram, at most ``capacity`` rows, comes to the driver, and only the
    plan goes out: its size does not grow with the pieces. Pieces of one length are
    interchangeable: each gets its place by its gapless rank among them, taken in salted
    groups, so that a length which a third of all pieces share is ranked by many tasks.
    """
    hist = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in hist:
        counts[r["length"]] = r["n"]
    plan = make_plan(counts, capacity, rounds)
    ranked = gapless_rank(pieces, ["length"], order or pieces.columns, "_slot", max(1, int(counts.sum())))
    cols = pieces.columns

    def assign(batches):
        for b in batches:
            sequence, offset = plan.place(b.column("length").to_numpy(), b.column("_slot").to_numpy())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in cols], pa.array(sequence), pa.array(offset)],
                                             [*cols, "sequence_id", "offset"])

    return ranked.select(*cols, "_slot").mapInArrow(trimmed(assign), ddl(pieces, "sequence_id long, offset long"))


def best_fit_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` tokens, as few as it can.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Each
    document ends with id 1, so NULL and empty texts are pieces of one token. Only documents
    longer than ``capacity`` are cut. Ids may be NULL, tied or repeated: every row is packed.
    """
    return pack(stage(token_pieces(docs, tokenizer, capacity), "pieces"), capacity, rounds)
