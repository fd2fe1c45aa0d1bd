"""WARC writer and reader: exact round trip, same bytes on any partitioning, commit by manifest."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
from collections import Counter

import duckdb
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candleframe.llm import warc
from candleframe.llm.queries import QUERIES
from candleframe.llm.warc import MANIFEST, read_warc, write_warc

SF = "/root/testdata/sf0.01"
DDL = "page_id long, url string, html string"
LONG = "".join(random.Random(1).choices("abcdefghij é漢", k=700_000))
PAGES = [
    (1, "http://a/1", "one"), (2, "http://a/2", "two"), (3, None, "one"), (3, None, "one"), (3, "http://b/3", "one"),
    (4, "http://a/\r\nX: y\tz", None), (5, "http://a/5", ""), (None, "http://a/n", "one"), (None, None, None),
    (6, "http://ü/漢", LONG), (7, "http://a/7", "x\r\n\r\nWARC/1.1\r\n\r\n"), (-8, "http://a/8", "two"), (2**62, "u", "big"),
]


def b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages, least=0):
    """(page_id, bytes, digest, type, refers_to) of every page."""
    def key(page_id):
        return (page_id is not None, page_id or 0)

    groups = {}
    for i, (p, _, h) in enumerate(pages):
        groups.setdefault((h or "").encode(), []).append((key(p), i, p))
    out = []
    for payload, own in groups.items():
        _, chosen, largest = max(own)
        for _, i, p in own:
            again = i != chosen and len(payload) >= least
            out.append((p, len(payload), b32(payload), "revisit" if again else "response", largest if again else None))
    return Counter(out)


def found(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def archives(path):
    return {n: open(f"{path}/{n}", "rb").read() for n in sorted(os.listdir(path)) if n.endswith(".warc.gz")}


def test_op11(spark):
    pages = duckdb.execute(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    assert found(QUERIES["op11_warc"](spark, SF)) == expected(pages)


@pytest.mark.parametrize("least", [0, 1, 4])
def test_round_trip(spark, tmp_path, least):
    path = str(tmp_path / "w")
    write_warc(spark.createDataFrame([(*p, "x") for p in PAGES], DDL + ", extra string"), path, min_bytes=least)
    got = read_warc(spark, path, with_payload=True)
    assert found(got) == expected(PAGES, least)
    rows = got.collect()
    assert len({r.record_id for r in rows}) == len(rows)
    by_id = {r.record_id: r for r in rows}
    for r in rows:
        if r.record_type == "revisit":
            of = by_id[r.refers_to_record]
            assert of.record_type == "response" and of.payload_digest == r.payload_digest and of.page_id == r.refers_to and r.payload is None
        else:
            assert len(r.payload) == r.payload_bytes and b32(r.payload) == r.payload_digest
    payloads = Counter(bytes(r.payload) for r in rows if r.record_type == "response")
    assert set(payloads) == {(h or "").encode() for _, _, h in PAGES}
    assert {r.url for r in rows if r.page_id == 4} == {"http://a/%0D%0AX:%20y%09z"}


def test_files_are_plain_gzip_in_order(spark, tmp_path):
    path = str(tmp_path / "w")
    write_warc(spark.createDataFrame(PAGES, DDL), path, shard_bytes=5_000, file_bytes=300)
    files = archives(path)
    assert len(files) > 3 and set(os.listdir(path)) >= {MANIFEST} and not [n for n in os.listdir(path) if n.startswith("tmp")]
    ids = []
    for name, data in files.items():
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and name.encode() in text
        for _, raw in warc.members(memoryview(data)):
            fields, _ = warc.parse(raw)
            if fields["WARC-Type"] != "warcinfo":
                ids.append(int(fields.get("WARC-Page-ID", -(2**63))))
    assert ids == sorted(ids) and len(ids) == len(PAGES)
    assert found(read_warc(spark, path)) == expected(PAGES)


def test_same_bytes_on_any_partitioning(spark, tmp_path):
    rng = random.Random(7)
    pages = [(rng.randrange(300), rng.choice(["u", "v", None]), rng.choice(["", "same", f"page {i} " * 40])) for i in range(600)]
    small = {"shard_bytes": 100_000, "file_bytes": 4_000}
    write_warc(spark.createDataFrame(pages, DDL).repartition(1), str(tmp_path / "a"), **small)
    rng.shuffle(pages)
    write_warc(spark.createDataFrame(pages, DDL).repartition(9), str(tmp_path / "b"), **small)
    a, b = archives(tmp_path / "a"), archives(tmp_path / "b")
    assert a == b and len(a) > 8
    # Rolled by compressed size: every file but the last of its shard holds at least that much.
    shards = Counter(n.split("-")[1] for n in a)
    assert all(len(d) >= 4_000 for n, d in a.items() if int(n.split("-")[2][:5]) < shards[n.split("-")[1]] - 1)
    assert found(read_warc(spark, str(tmp_path / "a"))) == expected(pages)


def test_a_hot_payload(spark, tmp_path):
    pages = [(i, f"http://h/{i}", "copy" if i % 3 else f"page {i}") for i in range(2_000)]
    write_warc(spark.createDataFrame(pages, DDL), str(tmp_path / "w"), shard_bytes=200_000)
    assert found(read_warc(spark, str(tmp_path / "w"))) == expected(pages)


def test_empty_table(spark, tmp_path):
    write_warc(spark.createDataFrame([], DDL), str(tmp_path / "w"))
    assert archives(tmp_path / "w") == {} and read_warc(spark, str(tmp_path / "w")).collect() == []


def test_only_listed_and_whole_files_are_read(spark, tmp_path):
    path = tmp_path / "w"
    with pytest.raises(PySparkException):
        read_warc(spark, str(path))
    write_warc(spark.createDataFrame(PAGES, DDL), str(path))
    with pytest.raises(FileExistsError):
        write_warc(spark.createDataFrame(PAGES, DDL), str(path))
    (name,) = archives(path)
    (path / "pages-0000009-00000.warc.gz").write_bytes((path / name).read_bytes())  # no manifest lists it
    assert found(read_warc(spark, str(path))) == expected(PAGES)
    data = bytearray((path / name).read_bytes())
    data[len(data) // 2] ^= 1
    (path / f".{name}.crc").unlink()
    (path / name).write_bytes(bytes(data))
    with pytest.raises((PySparkException, Py4JJavaError), match="differs from the manifest"):
        read_warc(spark, str(path)).collect()


def test_the_last_byte_of_large_members():
    file = warc._File(0, 0, 0, 1)
    file.add(b"x" * (17 << 20))
    whole = file.content() + b"\0"
    assert gzip.decompress(whole).endswith(b"x" * 99)
    assert [at for at, _ in warc.members(memoryview(whole))][0] == 0 and len(list(warc.members(memoryview(whole)))) == 2


def test_extra_columns_of_any_name(spark, tmp_path):
    df = spark.createDataFrame(PAGES, DDL).withColumns({"o": F.lit(1), "key": F.lit("k"), "row": F.lit(0), "TEXT": F.lit("t"), "shard": F.lit(3)})
    write_warc(df, str(tmp_path / "w"))
    assert found(read_warc(spark, str(tmp_path / "w"))) == expected(PAGES)
