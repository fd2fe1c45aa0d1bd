"""Each stage of the pipeline against a brute-force version, on all that the one before kept."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_llm_queries import components
from tokenizers import Tokenizer

import corpus_pipeline
from candleframe.llm import oracle
from candleframe.llm.common import stage

SF = "/root/testdata/sf0.001"
WS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_lines(docs):
    holders = defaultdict(set)
    key = lambda line: line.strip(WS).translate(LOWER)
    for i, t in docs:
        for line in t.split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return [(i, "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i)) for i, t in docs]


def brute_spans(docs, match=200):
    seen = Counter()
    raw = [(i, t.encode()) for i, t in docs]
    for _, b in raw:
        seen.update(b[k : k + match] for k in range(len(b) - match + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - match + 1):
            if seen[b[k : k + match]] > 1:
                gone[k : k + match] = True
        out.append((i, bytes(np.frombuffer(b, np.uint8)[~gone]).decode(errors="ignore")))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """Documents before the first and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF), name))
    return out


def pairs(df):
    return sorted((r.doc_id, r.text or "") for r in df.collect())


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "suffix_dedup", "packing"]


def test_columns_are_those_of_documents(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
        assert all(r.n_chars == len(r.text) for r in df.collect())


def test_quality(stages):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({oracle.QUALITY}) WHERE kept").fetchall()}
    assert pairs(stages[1]) == [p for p in pairs(stages[0]) if p[0] in kept]
    assert 0 < len(kept) < stages[0].count()


def test_line_dedup(stages):
    assert pairs(stages[2]) == sorted(brute_lines(pairs(stages[1])))


def test_near_duplicates(stages):
    before = pairs(stages[2])
    stays = {i for i, _, c in components(before, 5, 80, 100) if i == c}
    assert pairs(stages[3]) == [p for p in before if p[0] in stays]
    assert len(stays) < len(before)


def test_suffix_dedup(stages):
    assert pairs(stages[4]) == sorted(brute_spans(pairs(stages[3])))


def test_packing(stages):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, text in pairs(stages[4]):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        for k in range(-(-len(ids) // 4096)):
            part = ids[4096 * k : 4096 * (k + 1)]
            want.add((i, k, 4096 * k, len(part), zlib.crc32(part.tobytes())))
    got = stages[5].collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 4096


def test_planted_cases(spark):
    """Copies, near copies, a shared passage and junk are caught; clean documents stay whole."""
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))

    def prose(n):
        return " ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(n))

    clean = {i: prose(200) for i in range(20)}
    near = clean[3].split(" ")
    near[50] = "changed"
    passage = prose(60)
    docs = dict(clean)
    docs |= {100: clean[2], 101: " ".join(near), 102: prose(80) + " " + passage + " " + prose(80), 103: passage + " " + prose(90)}
    docs |= {104: "too short", 105: (prose(8) + " ") * 30}
    df = spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t)) for i, t in docs.items()],
                               "doc_id long, text string, lang string, source string, n_chars long")
    out = df
    for name, function in corpus_pipeline.STAGES[:4]:
        out = stage(function(spark, out, SF), name)
    got = {r.doc_id: r.text for r in out.collect()}
    assert set(got) == set(clean) | {102, 103}
    assert all(got[i] == t for i, t in clean.items())
    assert passage not in got[102] and passage not in got[103]
    assert len(re.findall(r"\w+", got[102])) >= 158


def test_near_duplicates_with_null_and_tied_ids(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("a") + " x"), (7, text("b")), (3, text("b") + " y"), (None, text("b")),
            (9, text("c")), (9, text("c")), (7, text("d")), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, (r.text or "-")[0]) for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()]
    assert Counter(got) == Counter([(None, "a"), (3, "b"), (9, "c"), (7, "d"), (None, "-"), (None, "-")])
