"""External induced suffix sorting with common-prefix values, vectorised by bucket.

The order of all suffixes is induced from that of the LMS suffixes (those that start with a
smaller character than their left neighbour's suffix class): a queue per first character
holds suffix tuples (position, common prefix with the tuple before it) in the order of
their ranks; popping a queue yields the next suffixes of the final order, and pushes their
left neighbours. Queues keep a bounded number of tuples in memory and the rest in unlinked
temporary files, which end with the task.

LMS suffixes themselves: the same induction sorts the LMS substrings, equal ones get one
name, and the reduced string of names is ordered by doubling names until the wanted depth
is reached (two levels instead of a full recursion: windows are only compared to a depth).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Tuples that one queue keeps in memory before it writes them to its file.
IN_MEMORY = 1 << 18
#: Tuples that are taken from a queue at a time.
CHUNK = 1 << 16

_TUPLE = np.dtype([("pos", "<i8"), ("lcp", "<i4")])


class TupleQueue:
    """First in, first out, of suffix tuples; what exceeds ``IN_MEMORY`` waits on disk."""

    def __init__(self):
        self.head: list[np.ndarray] = []
        self.tail: list[np.ndarray] = []
        self.held, self.file, self.on_disk, self.read = 0, None, 0, 0

    def push(self, tuples: np.ndarray) -> None:
        self.tail.append(tuples)
        self.held += len(tuples)
        if self.held > IN_MEMORY:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for part in self.tail:
                part.tofile(self.file)
                self.on_disk += len(part)
            self.tail, self.held = [], 0

    def pop(self) -> np.ndarray | None:
        """The next tuples, or None when the queue is empty."""
        if self.on_disk > self.read:
            n = min(CHUNK, self.on_disk - self.read)
            self.file.seek(self.read * _TUPLE.itemsize)
            out = np.fromfile(self.file, _TUPLE, n)
            self.read += n
            return out
        if self.tail:
            out = np.concatenate(self.tail)
            self.tail, self.held = [], 0
            return out
        return None

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts right of it (S type)."""
    up = np.empty(len(t), dtype=np.int8)
    up[:-1] = (t[1:] > t[:-1]).astype(np.int8) - (t[1:] < t[:-1]).astype(np.int8)
    up[-1] = -1  # the end is smaller than any character
    at = np.where(up != 0, np.arange(len(t)), len(t))
    nxt = np.minimum.accumulate(at[::-1])[::-1]  # the first change from here on
    return up[nxt] > 0


def _runs(t: np.ndarray) -> np.ndarray:
    """How often each position's character repeats from there on."""
    last = np.append(np.flatnonzero(t[1:] != t[:-1]), len(t) - 1)
    return np.repeat(last, np.diff(last, prepend=-1)) - np.arange(len(t)) + 1


class _Pass:
    """One sweep over the characters, upwards for L types or downwards for S types."""

    def __init__(self, t: np.ndarray, goes_here: np.ndarray, cap: int):
        self.t, self.here, self.cap = t, goes_here, cap
        self.queues = {}
        self.since = np.full(256, cap, dtype=np.int64)  # least lcp seen since a queue's last push

    def induce(self, tuples: np.ndarray) -> None:
        """Push the left neighbours of ``tuples``, the next ones in order of the sweep."""
        lcp = np.minimum(tuples["lcp"], self.cap).astype(np.int64)
        left = tuples["pos"] - 1
        ok = np.flatnonzero(left >= 0)
        ok = ok[self.here[left[ok]]]
        if len(ok):
            ch = self.t[left[ok]]
            order = np.argsort(ch, kind="stable")
            src, ch = ok[order], ch[order]
            starts = np.flatnonzero(np.append(True, ch[1:] != ch[:-1]))
            # Between two sources that go to one queue: the least lcp after the first, up to the second.
            value = _range_min(lcp, np.append(0, src[:-1] + 1), src + 1)
            prefix = np.minimum.accumulate(lcp)
            suffix = np.append(np.minimum.accumulate(lcp[::-1])[::-1], self.cap)
            heads = ch[starts].astype(np.int64)
            value[starts] = np.minimum(self.since[heads], prefix[src[starts]])
            out = np.empty(len(src), dtype=_TUPLE)
            out["pos"], out["lcp"] = left[src], np.minimum(value + 1, self.cap)
            first = self.since[heads] < 0
            out["lcp"][starts[first]] = 0
            ends = np.append(starts[1:], len(src))
            low = int(lcp.min())
            keep = self.since.copy()
            self.since = np.minimum(self.since, low)
            self.since[keep < 0] = -1
            for c, lo, hi in zip(heads.tolist(), starts.tolist(), ends.tolist(), strict=True):
                self.queues.setdefault(c, TupleQueue()).push(out[lo:hi])
                self.since[c] = suffix[src[hi - 1] + 1]
        else:
            fresh = self.since < 0
            self.since = np.minimum(self.since, int(lcp.min(initial=self.cap)))
            self.since[fresh] = -1

    def start(self) -> None:
        self.since[:] = -1  # nothing pushed yet: a queue's first tuple has no neighbour

    def drain(self, c: int) -> Iterator[np.ndarray]:
        """Tuples of queue ``c`` in order; what they push into it follows."""
        while c in self.queues:
            got = self.queues[c].pop()
            if got is None:
                self.queues.pop(c).close()
                return
            yield got
            self.induce(got)


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo:hi] for every pair (0 where lo >= hi, unused)."""
    out = np.zeros(len(lo), dtype=values.dtype)
    ok = np.flatnonzero(lo < hi)
    if len(ok):
        padded = np.append(values, values[-1:])
        index = np.stack([lo[ok], hi[ok]], axis=1).ravel()
        out[ok] = np.minimum.reduceat(padded, index)[::2]
    return out


def _sweep(t: np.ndarray, small: np.ndarray, runs: np.ndarray, seeds: np.ndarray, cap: int) -> Iterator[np.ndarray]:
    """All suffixes as tuples, largest first; ``lcp`` is that with the next larger one.

    ``seeds``: tuples of the LMS suffixes, ascending, lcp with the one before.
    """
    up = _Pass(t, ~small, cap)
    up.start()
    edges = np.searchsorted(t[seeds["pos"]].astype(np.int64), np.arange(257)) if len(seeds) else np.zeros(257, dtype=np.int64)
    l_parts: dict[int, list[np.ndarray]] = {}
    tails = {}
    end = np.zeros(1, dtype=_TUPLE)
    end["pos"] = len(t)  # the empty suffix, smallest of all
    up.induce(end)
    for c in range(256):
        kept = TupleQueue()
        last = None
        for got in up.drain(c):
            kept.push(got)
            last = got[-1:]
        l_parts[c] = kept
        tails[c] = last
        mine = seeds[edges[c] : edges[c + 1]]
        if len(mine):
            mine = mine.copy()
            mine["lcp"][0] = 0 if last is None else min(int(runs[last["pos"][0]]), int(runs[mine["pos"][0]]), cap)
            for lo in range(0, len(mine), CHUNK):
                up.induce(mine[lo : lo + CHUNK])
    down = _Pass(t, small, cap)
    down.start()
    for c in range(255, -1, -1):
        first_s = None
        for got in down.drain(c):
            yield got
            first_s = got[-1:]
        # The bucket's L suffixes, largest first; the largest meets the smallest S suffix.
        part = l_parts.pop(c)
        chunks = []
        while (got := part.pop()) is not None:
            chunks.append(got)
        part.close()
        carry = 0
        if chunks and first_s is not None:
            carry = min(int(runs[chunks[-1]["pos"][-1]]), int(runs[first_s["pos"][0]]), cap)
        for got in chunks[::-1]:
            back = got[::-1].copy()
            # lcp with the one before (smaller) becomes lcp with the next larger one.
            own = back["lcp"].copy()
            back["lcp"][1:] = own[:-1]
            back["lcp"][0] = carry
            carry = int(own[-1])
            yield back
            down.induce(back)


_powers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _power_tables(n: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value of each character, powers of the base, powers of its inverse), kept between calls."""
    have = _powers.get(salt)
    if have is None or len(have[1]) < n:
        rng = np.random.default_rng(salt)
        table = rng.integers(0, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(salt << 8)
        size = 1 << max(16, int(n - 1).bit_length())
        tables = []
        with np.errstate(over="ignore"):
            for b in (base, np.uint64(pow(int(base), -1, 1 << 64))):
                power = np.full(size, b, dtype=np.uint64)
                power[0] = 1
                tables.append(np.cumprod(power))
        have = _powers[salt] = (table, *tables)
        if size > 1 << 21:
            del _powers[salt]  # for a very long text: not kept
    return have


class PrefixHash:
    """Polynomial hashes of any substring, from running sums (modulo 2^64)."""

    def __init__(self, t: np.ndarray, salt: int = 1):
        n = len(t)
        table, power, self.back = _power_tables(n + 1, salt)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(table[t] * power[:n], out=self.sums[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[hi] - self.sums[lo]) * self.back[lo]

    def grams(self, k: int) -> np.ndarray:
        """The hash of every run of ``k`` characters."""
        with np.errstate(over="ignore"):
            return (self.sums[k:] - self.sums[:-k]) * self.back[: len(self.sums) - k]


def _words(t: np.ndarray, more: int) -> np.ndarray:
    """The eight characters from each position on as one number; zeros after the end."""
    padded = np.zeros(len(t) + more + 8, dtype=np.uint8)
    padded[: len(t)] = t
    out = np.zeros(len(t) + more, dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(out)]
    return out


def _common(h: PrefixHash, t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of suffixes a and b, up to ``cap``."""
    most = np.minimum(cap, len(t) - np.maximum(a, b))
    # Neighbours in order either agree to the end or part early.
    same = h.of(a, a + most) == h.of(b, b + most)
    out = np.where(same, most, 0)
    words = _words(t, cap + 8)
    rest, at = np.flatnonzero(~same), 0
    while len(rest):
        differ = words[a[rest] + at] ^ words[b[rest] + at]
        equal = np.zeros(len(rest), dtype=np.int64)
        for k in range(1, 9):
            equal += differ < np.uint64(1 << (64 - 8 * k)) if k < 8 else differ == 0
        out[rest] += equal
        rest, at = rest[equal == 8], at + 8
    return np.minimum(out, most)


def suffix_order(t: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Tuples (pos, lcp) of all suffixes of ``t`` (uint8), largest first.

    ``lcp``: common prefix with the tuple before it (the next larger suffix), up to
    ``depth``; 0 where the first characters differ. Suffixes that agree beyond ``depth``
    may come in any order among themselves.
    """
    n = len(t)
    if not n:
        return
    small, runs = _types(t), _runs(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = np.zeros(len(lms), dtype=_TUPLE)
    if len(lms):
        hashes = PrefixHash(t)
        # Order of the LMS substrings: induce from the LMS positions in order of first character.
        rough = seeds.copy()
        rough["pos"] = lms[np.argsort(t[lms], kind="stable")]
        is_lms = np.zeros(n + 1, dtype=bool)
        is_lms[lms] = True
        order = np.concatenate([p["pos"][is_lms[p["pos"]]] for p in _sweep(t, small, runs, rough, 1)])[::-1]
        nxt = np.append(lms[1:], n - 1) + 1  # an LMS substring ends with the next LMS character
        end_of = np.zeros(n + 1, dtype=np.int64)
        end_of[lms] = nxt
        ends = end_of[order]
        code, size = hashes.of(order, ends), ends - order
        new = np.append(False, (code[1:] != code[:-1]) | (size[1:] != size[:-1]))
        name = np.empty(n + 1, dtype=np.int64)
        name[order] = np.cumsum(new)
        # Names of 1, 2, 4, ... LMS substrings, until all differ or reach the depth.
        rank, step = name[lms], 1
        m = len(lms)
        while 2 * step < depth + 4 and rank.max() < m - 1:  # an LMS substring is at least two long
            pair = np.append(rank[step:] + 1, np.zeros(min(step, m), dtype=np.int64))[:m]
            key = rank * (m + 1) + pair
            by = np.argsort(key)
            sorted_key = key[by]
            rank = np.empty(m, dtype=np.int64)
            rank[by] = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
            step *= 2
        pos = lms[np.argsort(rank)]
        seeds["pos"] = pos
        seeds["lcp"][1:] = _common(hashes, t, pos[:-1], pos[1:], depth)
    yield from _sweep(t, small, runs, seeds, depth)


def repeated(t: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """For every position: is it ``wanted`` and does another wanted one start ``depth`` equal characters?"""
    out = np.zeros(len(t), dtype=bool)
    last, low = -1, depth
    for tuples in suffix_order(t, depth):
        tuples = tuples[tuples["pos"] < len(t)]
        lcp = tuples["lcp"].astype(np.int64)
        at = np.flatnonzero(wanted[tuples["pos"]])
        if not len(at):
            low = min(low, int(lcp.min(initial=depth)))
            continue
        pos = tuples["pos"][at]
        between = _range_min(lcp, np.append(0, at[:-1] + 1), at + 1)
        between[0] = min(low, between[0])
        same = between >= depth
        if last < 0:
            same[0] = False
        out[pos[same]] = True
        if same[0]:
            out[last] = True
        out[pos[:-1][same[1:]]] = True
        last, low = int(pos[-1]), int(lcp[at[-1] + 1 :].min(initial=depth))
    return out
