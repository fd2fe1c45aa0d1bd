"""The registered queries on the sf0.01 tables against independent brute-force versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from candleframe.llm import oracle, queries

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "pages", "labels", "embeddings")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs():
    return duckdb.execute(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name, *cols):
    df = queries.QUERIES[name](spark, SF)
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.execute(oracle.ORACLE[name])
    cols = [d[0] for d in rel.description]
    assert Counter(rows(spark, name, *cols)) == Counter(rel.fetchall())


def test_op1(spark, docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = set()
    for i, t in docs:
        ids = sp.encode(t)
        pieces = sp.encode(t, return_type="proto").pieces
        spans = ";".join(",".join(str(getattr(p, end)) for p in pieces) for end in ("begin", "end"))
        want.add((i, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)), len(t.encode()), zlib.crc32(spans.encode())))
    assert set(rows(spark, "op1_sentencepiece", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered", "spans_crc32")) == want


def test_op2(spark, docs):
    got = rows(spark, "op2_sharding", "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
    text = dict(docs)
    assert sorted(r[0] for r in got) == [i for i, _ in docs]
    assert all(r[1] == len(text[r[0]].encode()) + 8 and r[2] == zlib.crc32(text[r[0]].encode()) for r in got)
    by = defaultdict(list)
    for r in got:
        by[r[4]].append(r[5])
    assert set(by) <= set(range(24)) and {r[3] for r in got} == {"rows"} and {r[6] for r in got} == {None}
    counts = [len(by[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    # Every group of copies that fits a shard is whole.
    shards = defaultdict(set)
    for r in got:
        shards[text[r[0]]].add(r[4])
    assert sum(len(s) - 1 for s in shards.values()) == 0


def test_op3(spark):
    v = duckdb.execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    ids = np.array([i for i, _ in v])
    m = np.floor(64 * np.array([x for _, x in v], dtype=np.float64)).astype(np.int64)
    want = set()
    for q in np.flatnonzero(ids % 20 == 0):
        s = m @ m[q]
        order = [c for c in np.lexsort((ids, -s)) if ids[c] != ids[q]][:20]
        want |= {(int(ids[q]), k + 1, int(ids[c]), int(s[c])) for k, c in enumerate(order)}
    got = rows(spark, "op3_top_k", "query_id", "rank", "vec_id", "score")
    assert len(got) == len(want) and set(got) == want


def token_ids(docs):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: np.array([*t.encode(x, add_special_tokens=False).ids, 1], dtype="<u4") for i, x in docs}


def test_op5(spark, docs):
    got = rows(spark, "op5_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    ids = token_ids(docs)
    want = {(i, k, 4096 * k, len(p), zlib.crc32(p.tobytes())) for i, x in ids.items()
            for k in range(-(-len(x) // 4096)) for p in [x[4096 * k : 4096 * (k + 1)]]}
    assert len(got) == len(want) and {g[:5] for g in got} == want
    by = defaultdict(list)
    for g in got:
        by[g[5]].append((g[6], g[3]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(map(len, ids.values()))
    assert len(by) <= 1.02 * total / 4096 + 1


def test_op8(spark, docs):
    seen = Counter()
    for _, t in docs:
        b = t.encode()
        seen.update(hashlib.blake2b(b[i : i + 200], digest_size=8).digest() for i in range(len(b) - 199))
    want = set()
    for i, t in docs:
        b = t.encode()
        gone = np.zeros(len(b) + 2, dtype=bool)
        for s in range(len(b) - 199):
            if seen[hashlib.blake2b(b[s : s + 200], digest_size=8).digest()] > 1:
                gone[s + 1 : s + 201] = True
        kept = bytes(c for c, g in zip(b, gone[1:], strict=False) if not g)
        want.add((i, len(b), int(gone.sum()), int((gone[1:] > gone[:-1]).sum()), sha(kept)))
    assert set(rows(spark, "op8_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == want


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(docs, k, num, den):
    sets = {i: shingles(t, k) for i, t in docs}
    index = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            index[g].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    common = Counter()
    for members in index.values():
        common.update((a, b) for x, a in enumerate(members) for b in members[x + 1 :])
    for (a, b), n in common.items():
        if n * den >= (len(sets[a]) + len(sets[b]) - n) * num:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {(i, len(sets[i]), find(i)) for i in sets}


def test_op9(spark, docs):
    assert set(rows(spark, "op9_jaccard_join", "doc_id", "n_shingles", "component_id")) == components(docs, 4, 85, 100)


def test_op10(spark, docs):
    ids, start, want = token_ids(docs), 0, set()
    for i in sorted(ids):
        want.add((i, start, len(ids[i]), zlib.crc32(ids[i].tobytes())))
        start += len(ids[i])
    assert set(rows(spark, "op10_token_files", "doc_id", "start", "n_tokens", "ids_crc32")) == want
