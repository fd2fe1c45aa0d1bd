"""Merkle manifest against a plain tree, with blocks of several sizes and odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candleframe.llm import merkle
from candleframe.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest

DDL = "doc_id long, text string, source string, extra string"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i : i + 3])) for i in range(0, len(x), 3)])
    return levels


def siblings(levels, p):
    out = []
    for level in levels[:-1]:
        run = p // 3 * 3
        out.append(("".join(level[run:p]), "".join(level[p + 1 : run + 3])))
        p //= 3
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, proof) of (doc_id, text, source) rows."""
    groups = {}
    for d, t, s in rows:
        groups.setdefault(s, []).append((d is not None, d or 0, sha(field(d) + field(t))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[s])]) for s in order]
    top = tree([t[-1][0] for t in trees])
    return [
        (d if known else None, leaf, t[-1][0], top[-1][0], tuple(siblings(t, p) + siblings(top, k)))
        for k, (s, t) in enumerate(zip(order, trees, strict=True))
        for p, (known, d, leaf) in enumerate(sorted(groups[s]))
    ]


def manifest(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], DDL).withColumn("leaf", leaf_digest("doc_id", "text"))
    return merkle_manifest(df)


def found(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.proof)) for r in df.collect()]


ODD = [
    (1, None, "a"), (2, "", "a"), (3, "ü\n漢", "a"), (3, "ü\n漢", "a"), (3, "other", "a"), (None, "n", "a"), (None, None, "a"),
    (None, "n", None), (7, "x" * 300_000, None), (8, "lone", "é"), (9, "z", "z"), (10, "z", "Z"), (11, "", ""),
]


def test_odd_rows(spark):
    got = found(manifest(spark, ODD))
    assert Counter(got) == Counter(plain(ODD))


@pytest.mark.parametrize("depth", [1, 2, 5])
def test_block_sizes(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    monkeypatch.setattr(merkle, "SPANS", [3**j for j in range(depth)])
    rng = random.Random(depth)
    rows = [(i, f"t{rng.random()}", f"s{n}") for n in (1, 2, 3, 4, 9, 10, 27, 28, 31) for i in range(n)]
    got = found(manifest(spark, rows))
    assert Counter(got) == Counter(plain(rows))


def test_many_groups_and_a_hot_one(spark):
    rows = [(i, "t", f"g{i}") for i in range(300)] + [(i, "same", "hot") for i in range(700)]
    got = found(manifest(spark, rows))
    assert Counter(got) == Counter(plain(rows))


def test_folding_sees_any_change(spark):
    df = manifest(spark, ODD).withColumns({
        "ok": fold(F.col("leaf"), F.col("proof")) == F.col("root"),
        "bad": fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root"),
        "digest": proof_digest(F.col("proof"))})
    for r in df.collect():
        assert r.ok and not r.bad
        assert r.digest == sha("".join(s.left + s.right for s in r.proof))


def test_empty_single_and_clashing_names(spark):
    assert manifest(spark, []).collect() == []
    (one,) = found(manifest(spark, [(5, "t", None)]))
    assert one == (5, sha("1:51:t"), sha("1:51:t"), sha("1:51:t"), ())
    df = spark.createDataFrame([(*r, "x") for r in ODD], DDL).withColumns(
        {"leaf": leaf_digest("doc_id", "text"), "ROOT": F.lit(1), "_g": F.lit("g"), "_at": F.lit(7), "o": F.lit(1), "carry": F.lit(2)})
    out = merkle_manifest(df)
    assert out.columns == ["doc_id", "text", "source", "extra", "leaf", "_g", "_at", "o", "carry", "subroot", "root", "proof"]
    assert {(r._g, r._at, r.o, r.carry, r.extra) for r in out.collect()} == {("g", 7, 1, 2, "x")}
    assert Counter(found(out)) == Counter(plain(ODD))


def test_input_order_and_partitions_do_not_matter(spark):
    rows = [(i % 40, f"t{i % 50}", f"s{i % 4}") for i in range(200)]
    a = Counter(found(manifest(spark, rows)))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], DDL).repartition(13).withColumn("leaf", leaf_digest("doc_id", "text"))
    assert Counter(found(merkle_manifest(df))) == a == Counter(plain(rows))
