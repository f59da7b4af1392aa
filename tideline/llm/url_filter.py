"""URL filter: allow and block rules, then a Bloom filter cascade over listed host names.

*Rules* are (verdict, "host/path") pairs: a rule fits its host and all subdomains, if the
url's path starts with the rule's; the longest rule that fits decides.

*Cascade.*  Where no rule fits, a url is blocked if its host or a parent domain is a listed
key.  The key universe is every host name suffix that the corpus has.  Level 1 encodes the
listed keys of the universe, level 2 the other keys that pass level 1, level 3 the listed
keys that pass level 2, and so on, until a level has no false positive left.  A key's answer is the
parity of the first level that it doesn't pass, so over the universe membership is exact, and
a page is judged from a few broadcast bit arrays, without a join.

Scale: the universe is built from distinct hosts, grouped before the shuffle, so a host that
has a third of all pages is one row of a task.  A level's bits are set in tasks and combined
by OR per 64-bit word.  The levels take about 2 bytes for a listed key; they are broadcast only
up to ``max_bytes`` (known before they are built); a longer list is joined with the distinct
hosts instead, with the same verdicts.

Edge cases: null urls and urls without ``://`` have an empty host and path, fit no rule and are
allowed; an empty list blocks nothing; null keys of the list are ignored; repeated rows are
judged alike; an empty table gives none.  The input row is held in one struct, so column names
can't clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tideline.llm.common import Shared, materialise, mix64
from tideline.sources.tables import read_table

MAX_BYTES = 256 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# The rules of the registered query, and the words that its list is made from.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
LISTED_WORDS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def suffixes(host: str) -> list[str]:
    """The host and its parent domains."""
    parts = host.split(".")
    return [".".join(parts[i:]) for i in range(len(parts))] if host else []


def digests(keys: list[str]) -> np.ndarray:
    """Two 64-bit hashes of every key."""
    raw = b"".join(xxhash.xxh3_128_digest(k.encode()) for k in keys)
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


class Level:
    """A Bloom filter: number of bits, hash functions, and the bits as bytes."""

    def __init__(self, number: int, n: int, rate: float):
        self.number = number
        self.k = max(1, math.ceil(-math.log2(rate)))
        self.m = max(64, math.ceil(n * self.k / math.log(2)))
        self.bits: np.ndarray | None = None

    def places(self, d: np.ndarray) -> np.ndarray:
        """(keys, k) bit places."""
        seed = np.uint64(self.number * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        a, b = mix64(d[:, :1] ^ seed), mix64(d[:, 1:] + seed) | np.uint64(1)
        return (a + np.arange(self.k, dtype=np.uint64) * b) % np.uint64(self.m)

    def passes(self, d: np.ndarray) -> np.ndarray:
        at = self.places(d)
        return ((self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)

    def fill(self, keys: DataFrame) -> "Level":
        """Set the bits of all keys; only 64-bit words with a bit set reach the driver."""

        def task(batches, self=self):
            words = {}
            for batch in batches:
                at = self.places(digests(batch.column("key").to_pylist())).ravel()
                for w, b in zip((at >> np.uint64(6)).tolist(), (np.uint64(1) << (at & np.uint64(63))).tolist()):
                    words[w] = words.get(w, 0) | b
            bits = np.array(list(words.values()), np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.int64()), pa.array(bits)], names=["w", "b"])

        bits = np.zeros(self.m // 64 + 1, np.uint64)
        for r in keys.mapInArrow(task, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toLocalIterator():
            bits[r["w"]] = r["b"] & (1 << 64) - 1
        self.bits = bits
        return self


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, keys: list[str]) -> np.ndarray:
        """Exact for every key of the universe that the cascade was built over."""
        d, out = digests(keys), np.full(len(keys), len(self.levels) % 2 == 1)
        left = np.arange(len(keys))
        for level in self.levels:
            ok = level.passes(d[left])
            out[left[~ok]] = level.number % 2 == 0
            left = left[ok]
        return out


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = Shared(keys.sparkSession, level)

    def task(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(digests(batch.column("key").to_pylist()))))

    return keys.mapInArrow(task, "key string")


def cascade_bytes(listed: int, others: int) -> int:
    """Upper estimate of all levels' size: the first, and halves of it from there on."""
    rate = min(0.5, math.sqrt(0.5) * max(1, listed) / max(1, others))
    return int(listed * (math.ceil(-math.log2(rate)) + 6) / math.log(2) / 8) + 1024


def build_cascade(universe: DataFrame) -> Cascade:
    """universe: (key, listed), distinct keys."""
    inside = universe.filter("listed").select("key")
    outside = universe.filter("NOT listed").select("key")
    n = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
    levels, mine, other, count = [], inside, outside, n.get(True, 0)
    rate = min(0.5, math.sqrt(0.5) * max(1, count) / max(1, n.get(False, 0)))
    while count:
        levels.append(Level(len(levels) + 1, count, rate).fill(mine))
        mine, other = materialise(_passing(other, levels[-1]), "cascade"), mine
        count, rate = mine.count(), 0.5
    return Cascade(levels)


def with_host_and_path(df: DataFrame, url: Column) -> DataFrame:
    host = F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER)
    return df.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(F.regexp_extract(url, _URL, 2), F.lit("")))


def key_universe(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """(key, listed): every suffix of the hosts, and whether the list has it.  hosts: (host)."""
    parts = F.split("host", r"\.", -1)
    every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    keys = hosts.filter("host <> ''").distinct().select(F.explode(every).alias("key")).distinct()
    return keys.join(listed.select("key", F.lit(True).alias("l")).filter("key IS NOT NULL").distinct(), "key", "left").select("key", F.coalesce("l", F.lit(False)).alias("listed"))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], url: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(row, host, path, rule, listed, verdict).  listed: (key) host names."""
    df = with_host_and_path(pages.select(F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row")), F.col("row")[url])
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(slash + path))
        rule, said = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(said)
    df = df.withColumn("rule", rule).withColumn("said", said)
    universe = materialise(key_universe(df.select("host"), listed), "key-universe")
    n = {r["listed"]: r["count"] for r in universe.groupBy("listed").count().collect()}
    if cascade_bytes(n.get(True, 0), n.get(False, 0)) > max_bytes:
        hit = key_universe(df.select("host"), listed).filter("listed").select("key")
        parts = F.split("host", r"\.", -1)
        every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
        hosts = df.select("host").distinct().withColumn("key", F.explode(every)).join(hit, "key").select(F.col("host").alias("h")).distinct()
        df = df.join(hosts, F.col("host") == F.col("h"), "left").withColumn("listed", F.col("h").isNotNull()).drop("h")
    else:
        shared = Shared(pages.sparkSession, build_cascade(universe))

        def task(batches):
            for batch in batches:
                hosts = batch.column("host").to_pylist()
                own = {h: suffixes(h) for h in set(hosts)}
                keys = sorted({k for ks in own.values() for k in ks})
                hit = dict(zip(keys, shared.value.listed(keys).tolist())) if keys else {}
                found = {h: any(hit[k] for k in ks) for h, ks in own.items()}
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([found[h] for h in hosts], pa.bool_())], names=[*batch.schema.names, "listed"])

        df = df.mapInArrow(task, T.StructType([*df.schema, T.StructField("listed", T.BooleanType())]))
    return df.withColumn("verdict", F.coalesce("said", F.when(F.col("listed"), "block").otherwise("allow"))).drop("said")


def listed_hosts(pages: DataFrame, words: list[str], url: str = "url") -> DataFrame:
    """(key): domains of the corpus whose first label holds one of the words."""
    hosts = with_host_and_path(pages, F.col(url)).select("host").distinct()
    parts = F.split("host", r"\.", -1)
    every = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    first = F.regexp_extract("key", r"^([^.]*)\.", 1)
    return hosts.select(F.explode(every).alias("key")).distinct().filter(first.rlike("|".join(words)))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge_urls(pages, listed_hosts(pages, LISTED_WORDS), RULES)
    return out.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                     WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                     WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)[^.]*\.') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
