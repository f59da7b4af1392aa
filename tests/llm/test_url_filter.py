import random

import edge
import pytest
from pyspark.sql import functions as F
from tideline.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:n], rest[n:]
    n = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:n]


def brute(url, listed):
    host, path = parts(url)
    best = None
    for verdict, rule in U.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    if best:
        return host, path, best[1], best[0]
    return host, path, None, "block" if any(s in listed for s in U.suffixes(host)) else "allow"


def urls():
    rng = random.Random(6)
    hosts = [f"{a}{b}.{c}" for a in ("", "www.", "M.", "a.b.") for b in [f"site{i}" for i in range(120)] + ["example"] for c in ("org", "com", "example.org", "net")]
    tails = ["", "/", "/en/1", "/en/12?x=/es/", "/es/", "/es", "/fr/a#b", "/de/", "?q=1", "#/de/", "/DE/", "/x y\nz"]
    return [rng.choice(["http", "HTTPS"]) + "://" + rng.choice(hosts) + rng.choice(tails) for _ in range(900)] + [None, "", "no-scheme.org/x", "://org/", "http://", "http://org", "a://b://c"]


@pytest.mark.parametrize("max_bytes", [U.MAX_BYTES, 0])
def test_same_as_brute_force(spark, max_bytes):
    rows = [(i, u) for i, u in enumerate(urls())]
    listed = {f"site{i}.net" for i in range(0, 120, 3)} | {"site7.example.com", "www.site8.net", "nowhere.example"}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame([(k,) for k in listed] + [(None,), ("site0.net",)], "key string")
    out = U.judge_urls(pages, table, U.RULES, max_bytes=max_bytes).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert {r.page_id: tuple(r)[1:] for r in out} == {i: brute(u, listed) for i, u in rows}


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 37 == 0).alias("listed"))
    cascade = U.build_cascade(keys)
    names = [f"k{i}" for i in range(20_000)]
    assert cascade.listed(names).tolist() == [i % 37 == 0 for i in range(20_000)]
    assert len(cascade.levels) > 2
    assert sum(x.m for x in cascade.levels) / 8 <= U.cascade_bytes(541, 19_459)
    assert not U.build_cascade(keys.filter("NOT listed")).listed(names).any()


def test_edges(spark):
    pages = edge.documents(spark).withColumn("url", F.when(F.col("doc_id") != 3, F.concat(F.lit("http://h"), "doc_id", F.lit(".net/x"))))
    none = spark.createDataFrame([], "key string")
    out = U.judge_urls(pages, none, U.RULES)
    assert [r.verdict for r in out.collect()] == ["allow"] * len(edge.ROWS) and out.first().row.asDict().keys() == {*pages.columns}
    one = spark.createDataFrame([("h1.net",)], "key string")
    assert out.count() == U.judge_urls(pages, one, U.RULES).count()
    assert U.judge_urls(pages, one, U.RULES).filter("verdict = 'block'").count() == 2
    assert U.judge_urls(pages.limit(0), one, U.RULES).count() == 0
