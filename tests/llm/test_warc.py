import gzip
import hashlib
import os
import random

import edge
import pytest
from pyspark.sql import functions as F
from tideline.llm import warc as W


def rows():
    rng = random.Random(7)
    bodies = ["", "same", "ü" * 40, "<p>" + "x" * 70_000 + "</p>", "a\r\n\r\nb"] + [f"own {i}" for i in range(30)]
    return [(i, f"http://h{i}.org/\n{i}", rng.choice(bodies)) for i in range(120)] + [(200, None, None), (201, "http://n", None)]


def brute(pages, min_bytes):
    last = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= min_bytes:
            last[raw] = max(last.get(raw, -1), i)
    out = {}
    for i, _, html in pages:
        raw = (html or "").encode()
        to = last.get(raw, i)
        out[i] = (len(raw), W.sha1_base32(raw), "response" if to == i else "revisit", None if to == i else to)
    return out


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, scratch, min_bytes):
    pages = rows()
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    W.write_pages(df, scratch + "/a", min_bytes=min_bytes)
    back = spark.read.format("warc").load(scratch + "/a").collect()
    want = brute(pages, min_bytes)
    assert len(back) == len(pages)
    for r in back:
        i = int(r.record_id.rsplit(":", 1)[1])
        size, digest, kind, to = want[i]
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (size, digest, kind, to if to is None else f"urn:page:{to}")
        if kind == "response":
            assert hashlib.sha1(r.payload).digest() and r.payload_sha1 == digest and len(r.payload) == size
        else:
            assert r.payload is None
        assert r.target_uri == (pages[i][1] or "").replace("\n", " ") if i < 120 else True


def test_files_are_standard_gzip_and_rolled(spark, scratch):
    df = spark.createDataFrame(rows(), "page_id long, url string, html string").coalesce(1)
    df = df.select(F.concat(F.lit("urn:x:"), "page_id").alias("record_id"), F.col("url").alias("target_uri"), F.col("html").cast("binary").alias("payload"), F.lit(None).cast("string").alias("refers_to"))
    W.register(spark)
    df.write.format("warc").mode("append").option("roll_bytes", 3000).save(scratch + "/b")
    files = [f for f in os.listdir(scratch + "/b") if f.endswith(".gz")]
    assert len(files) > 3
    n = 0
    for f in files:
        data = open(f"{scratch}/b/{f}", "rb").read()
        plain = gzip.decompress(data)
        n += plain.count(b"WARC/1.1\r\n")
        # plain files and members without lengths read the same
        want = list(W.read_records(data, lambda r: True, ["payload"]))
        assert list(W.read_records(plain, lambda r: True, ["payload"])) == want
        foreign = b"".join(gzip.compress(b"WARC/1.1\r\n" + x) for x in plain.split(b"WARC/1.1\r\n")[1:])
        assert list(W.read_records(foreign, lambda r: True, ["payload"])) == want
    assert n == len(rows())
    open(f"{scratch}/b/stray.warc.gz", "wb").write(b"left by a lost task")
    assert spark.read.format("warc").option("split_bytes", 1000).load(scratch + "/b").count() == n


def test_pushdown_and_skipped_payloads(spark, scratch, monkeypatch):
    W.write_pages(spark.createDataFrame(rows(), "page_id long, url string, html string"), scratch + "/c")
    df = spark.read.format("warc").schema("record_id string, record_type string").load(scratch + "/c").filter("record_type = 'revisit' and record_id in ('urn:page:1', 'urn:page:2', 'urn:page:3')")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(line.strip(" +-:*()0123456789").startswith("Filter") for line in plan.splitlines())
    big = W.gzip_member(W.make_record("r", None, os.urandom(500_000), None, "d"))
    asked = []
    own = W._Member.upto
    monkeypatch.setattr(W._Member, "upto", lambda self, n: asked.append(n) or own(self, n))
    assert len(list(W.read_records(big * 2, lambda r: True, ["record_id"]))) == 2 and max(asked) < 5_000
    asked.clear()
    assert not list(W.read_records(big * 2, lambda r: False, ["payload"])) and max(asked) < 5_000


def test_edges(spark, scratch):
    docs = edge.documents(spark).withColumnRenamed("doc_id", "page_id").withColumnRenamed("text", "html").withColumn("url", F.lit("http://x"))
    W.write_pages(docs, scratch + "/d")
    kinds = sorted((r.record_id or "", r.record_type) for r in spark.read.format("warc").load(scratch + "/d").collect())
    assert len(kinds) == len(edge.ROWS)
    assert [k for i, k in kinds if i == "urn:page:1"] == ["revisit"] * 2 and ("urn:page:2", "response") in kinds
    assert ("urn:page:3", "revisit") in kinds and ("urn:page:4", "response") in kinds and ("", "response") in kinds
    W.write_pages(docs.limit(0), scratch + "/e")
    assert spark.read.format("warc").load(scratch + "/e").count() == 0
