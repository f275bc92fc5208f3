"""WARC archives and exact vector search."""

import gzip
import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import registry, topk, warc

SF_DIR = "/root/testdata/sf0.001"


def _pages(spark):
    long = "é" * 600
    rows = [(1, "http://a/", "x" * 2000), (2, None, "x" * 2000), (3, "http://ü \r\n", "x" * 2000), (4, "u", long), (5, "u", long), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "u", None), (9, "u", ""), (10, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n"), (None, "u", "x" * 2000), (11, "u", "y" * 300_000), (5, "u", long)]
    return rows, spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    rows, pages = _pages(spark)
    got = warc.round_trip(spark, pages).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "") == (html or "")]
        last = max(same) if len(data) >= 1000 and page is not None and max(same) > page else None
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if last else "response", last))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=key) == sorted(expected, key=key)
    payloads = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert payloads[11] == b"y" * 300_000 and payloads[8] == b"" and payloads[10].endswith(b"WARC/1.1\r\n")
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_archives_are_one_stream_and_members_afterwards(spark, tmp_path):
    _, pages = _pages(spark)
    raw, fine = str(tmp_path / "raw"), str(tmp_path / "fine")
    written = warc.write_archives(warc.plan_records(pages), raw, archive_bytes=5000)
    written.write.parquet(str(tmp_path / "archives"))
    archives = spark.read.parquet(str(tmp_path / "archives"))
    assert archives.agg(F.sum("records")).first()[0] == 13 and archives.count() > 1
    for row in archives.collect():
        whole = zlib.decompressobj(31)
        with open(f"{raw}/{row.path}", "rb") as f:
            whole.decompress(f.read())
        assert whole.eof and not whole.unused_data
    warc.normalise(archives, raw, fine).write.parquet(str(tmp_path / "members"))
    for row in spark.read.parquet(str(tmp_path / "members")).collect():
        with open(f"{fine}/{row.path}", "rb") as f:
            data = f.read()
        lines = open(f"{fine}/{row['index']}").read().splitlines()
        assert len(lines) == row.records
        upto = 0
        for line in lines:
            offset, length, kind, _ = line.split("\t")
            assert int(offset) == upto
            upto += int(length)
            record = gzip.decompress(data[int(offset) : upto])
            assert record.startswith(b"WARC/1.1\r\n") and f"WARC-Type: {kind}".encode() in record
        assert upto == os.path.getsize(f"{fine}/{row.path}")


def test_normaliser_reads_many_members_and_rejects_cut_streams():
    record = warc._record(1, "u", b"abc", 3, "00" * 20, None, False, "d")
    for data in (gzip.compress(record * 3), gzip.compress(record) * 3, gzip.compress(record * 2) + gzip.compress(record)):
        found = [b"".join(pieces) for _, pieces in warc.split_records(warc.inflate(data[i : i + 7] for i in range(0, len(data), 7)))]
        assert found == [record] * 3
    with pytest.raises(ValueError):
        list(warc.inflate([gzip.compress(record)[:-9]]))
    with pytest.raises(ValueError):
        [list(p) for _, p in warc.split_records(iter([record[:-20]]))]


def _plain_top(rows, k):
    sound = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if q % 5 == 0:
            best = sorted((-int(a @ b), i) for i, b in sound if i != q and len(b) == len(a))[:k]
            out += [(q, rank + 1, i, -score) for rank, (score, i) in enumerate(best)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(topk, "CANDIDATES", 37)
    monkeypatch.setattr(topk, "QUERIES", 11)
    rows = [(i, [float(np.float32(x)) for x in (rng.normal(size=24) + (i % 3 == 0) * 2) / 3]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)] + [(400, None), (405, [1.0, None]), (410, [float("nan")] * 24), (415, [float("inf")] * 24), (420, []), (425, []), (430, [0.5] * 3), (435, [0.25] * 3), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).repartition(3)
    got = topk.top_k(spark, table, F.col("vec_id") % 5 == 0, 5).collect()
    assert sorted(map(tuple, got)) == _plain_top(rows, 5)
    assert topk.top_k(spark, table.limit(0), F.lit(True)).count() == 0


def test_bounds_never_drop_a_winner():
    rng = random.Random(2)
    for _ in range(40):
        d, n = rng.choice([1, 3, 16, 64]), rng.randint(1, 90)
        x = np.floor(np.random.default_rng(rng.random().__hash__()).normal(size=(n, d)) * 50)
        q, at, score = topk.best(x[:7], np.arange(min(7, n)), x, np.arange(n), 3)
        for i in range(min(7, n)):
            plain = sorted((-int(x[i] @ x[j]), j) for j in range(n) if j != i)[:3]
            assert [(-int(s), int(a)) for s, a in zip(score[q == i], at[q == i])] == plain


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = registry.queries()[name](spark, SF_DIR)
    rows = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
