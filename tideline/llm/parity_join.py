"""N-gram Jaccard self-join by parity sketches.

A document is the set of its distinct shingles of k words (64-bit hashes; fewer
words: the whole sequence is one shingle; no words: the empty set, linked with
nothing).  Two documents link when 100 * |A n B| >= threshold * |A u B|, and the
result is each document's connected component.  The query op3 takes k = ``SHINGLE``
and ``THRESHOLD`` (4, 85); the pipeline's stage takes 5 and 80.

Method
1. Documents with equal sets form one class; from here on a class is one node.
2. *Parity sketch.*  In a size band the shingles are dealt by hash to ``p`` cells.
   A shingle flips one of the 16 sketch bits of its cell, and its hash is XORed into
   the cell's 64-bit word.  One differing shingle changes one bit and one cell, so
   the Hamming distance of two sketches, in bits or in cells, is a lower bound of
   |A - B| + |B - A|.  (The words are what is joined on: bits alone would make cells
   of one or two shingles collide by chance, one time in 16.)
3. *Pigeonhole join per size band.*  Bands are cut at powers of 1.5; a set is listed
   in its own band, and in the next if a linked set may lie there.  Linked sets of a
   band differ in at most D shingles, so with p = D + 2 + D/10 cells at least
   2 + D/10 cells agree.  Listings are joined on (band, cell, word).
4. *Hot keys.*  A key of more than ``HOT`` listings (a passage that many documents
   share, or an empty cell) joins only listings that need it: one with more cells that
   are neither empty nor hot than shingles in which it can differ from a partner (``reach``,
   at most D) agrees with any partner on one of those already.  This leaves out no link.
5. *Prune and verify.*  Pairs from the other keys, and each listing that needs a hot
   key paired with the key's smallest node, are pruned by the number of agreeing
   cells and the Hamming distance, and compared exactly.  So a large group of near
   copies is tied together by stars, not by all its pairs.
6. What needs hot keys and is still in several components is compared in blocks of
   ``BLOCK`` sketches, pairs of different components only, first the closest pair of
   a node and a component, then the rest.  Pairs within a component need no check, as
   they can't change the result.

Exact up to collisions of 64-bit hashes (2^-64 a pair).

Scale: texts are read twice and never shuffled whole (the second time only the
nodes with a candidate).  Every key, node and edge is in a DataFrame; sketches,
edges and labels are written to the shared folder between steps.  A task lists
equal sets once, so copies are combined before the shuffle.

Edge cases: null and empty texts have 0 shingles and their own component; documents
with a null id link others as any document does, and a component is named by its
smallest non-null id (null if it has none); repeated rows give repeated rows; an
empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tideline.llm.common import drop_table, materialise, mix64, narrow_batches, raw_texts, text_slices
from tideline.sources.tables import read_table

THRESHOLD = 85
SHINGLE = 4
GROWTH = 1.5
BITS = 16
HOT = 50
BLOCK = 512
MAX_CACHED_WORDS = 120_000
MAX_CACHED_SETS = 100_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word)
        return x


def shingle_set(raw: bytes, hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; ASCII letters are lower-cased."""
    ws = raw.lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    if len(ws) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64)
    a = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
    n = len(a) - k + 1
    h = a[:n]
    for i in range(1, k):
        h = mix64(h) + a[i:n + i]
    return np.unique(mix64(h))


class Bands:
    """Size bands: where a set is listed, the allowed difference and the cells there."""

    def __init__(self, threshold: int = THRESHOLD):
        self.t, self.cuts, self.memo = threshold, [1], {}
        while self.cuts[-1] < 1 << 40:
            self.cuts.append(max(self.cuts[-1] + 1, math.ceil(self.cuts[-1] * GROWTH), math.ceil(self.cuts[-1] * 100 / threshold)))

    def differ(self, total):
        """Most shingles in which two linked sets of ``total`` shingles together can differ."""
        # |A n B| >= t (a + b) / (100 + t), and the difference is a + b - 2 |A n B|
        return total - 2 * -(-self.t * total // (100 + self.t))

    def listings(self, n: int) -> list[tuple[int, int, int]]:
        """(band, D, cells) of each listing of a set of n shingles; bands where only equal sets link have none."""
        if n not in self.memo:
            own = bisect.bisect_right(self.cuts, n) - 1
            out = []
            for band in (own, own + 1) if n * 100 // self.t >= self.cuts[own + 1] else (own,):
                most = 2 * (self.cuts[band + 1] - 1)
                d = max(self.differ(x) for x in range(max(2, most - 50), most + 1))
                if d:
                    out.append((band, d, d + 2 + d // 10))
            self.memo[n] = out
        return self.memo[n]

    def reach(self, n: int, band: int) -> int:
        """Most shingles in which a set of n can differ from a linked one of the band: its own part of the band's D."""
        most = n + min(self.cuts[band + 1] - 1, n * 100 // self.t)
        return max(self.differ(x) for x in range(max(2, most - 50), most + 1))


def sketch(s: np.ndarray, band: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the cells with shingles, keys of the empty cells, bits of all cells)."""
    h = mix64(s ^ np.uint64((band + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    cell = (h >> np.uint64(32)) % np.uint64(cells)
    order = np.argsort(cell, kind="stable")
    cell, h = cell[order], h[order]
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    at = cell[start]
    bits = np.zeros(cells, np.uint16)
    bits[at.astype(np.int64)] = np.bitwise_xor.reduceat(np.uint16(1) << (h & np.uint64(15)).astype(np.uint16), start)
    place = mix64(np.arange(cells, dtype=np.uint64) + np.uint64(band << 40))
    full = mix64(np.bitwise_xor.reduceat(mix64(h), start)) + place[at.astype(np.int64)]
    place[at.astype(np.int64)] = 0
    return full.view(np.int64), place[place != 0].view(np.int64), bits


_FOUND = "id {id}, h long, n long, digest binary, slot int, band int, d int, cells int, keys array<long>, empty array<long>, bits binary"


def _arrays(flat: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in flat])].astype(np.int32)),
                                    pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int64)))


def document_listings(docs: DataFrame, doc_id: str, text: str, threshold: int, k: int = SHINGLE) -> DataFrame:
    """A row per document (slot 0) and further listing (slot 1): sizes, digest of the set, sketch."""

    def task(batches):
        hashes, bands, seen, none = WordHashes(), Bands(threshold), set(), np.zeros(0, np.int64)
        for batch in text_slices(batches, "t"):
            rows = []
            for i, raw in enumerate(raw_texts(batch, "t")):
                s = shingle_set(raw, hashes, k)
                digest = xxhash.xxh128_digest(s.tobytes()) if len(s) else None
                lists = [] if digest is None or digest in seen else bands.listings(len(s))
                if len(seen) < MAX_CACHED_SETS:
                    seen.add(digest)
                for slot, (band, _, cells) in enumerate(lists):
                    full, empty, bits = sketch(s, band, cells)
                    rows.append((i, len(s), digest, slot, band, bands.reach(len(s), band), cells, full, empty, bits.tobytes()))
                if not lists:
                    rows.append((i, len(s), digest, 0, None, None, None, none, none, None))
            c = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x).take(pa.array(c[0], pa.int64())) for x in ("id", "h")), pa.array(c[1], pa.int64()), pa.array(c[2], pa.binary()),
                 *(pa.array(x, pa.int32()) for x in c[3:7]), _arrays(c[7]), _arrays(c[8]), pa.array(c[9], pa.binary())],
                names=["id", "h", "n", "digest", "slot", "band", "d", "cells", "keys", "empty", "bits"])

    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("t")).mapInArrow(
        task, _FOUND.format(id=docs.schema[doc_id].dataType.simpleString()))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over edges (a, b), for nodes with an edge.

    Alternating large-star and small-star rounds until nothing changes; each round is
    a grouped minimum (combined before the shuffle) and a join back."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, last = materialise(e, "edges"), None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small, before = large.join(low, "u"), e
        e = materialise(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
                        .filter("u <> v").distinct(), "edges")
        drop_table(before)
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == last:
            break
        last = now
    star = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    out = materialise(star.union(star.select(F.col("component").alias("node"), "component").distinct()), "components")
    drop_table(e)
    return out


def _exact(pairs: DataFrame, docs: DataFrame, classes: DataFrame, doc_id: str, text: str, threshold: int, k: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link, as a table."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(classes, "node").select("node", "rep", "digest")
    wanted = materialise(wanted, "wanted")

    def task(batches):
        hashes, seen = WordHashes(), set()
        for batch in text_slices(batches, "t"):
            out = {}
            for raw in raw_texts(batch, "t"):
                s = shingle_set(raw, hashes, k)
                if len(s) and (digest := xxhash.xxh128_digest(s.tobytes())) not in seen:
                    out[digest] = s.view(np.int64)
            seen.update(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), _arrays(list(out.values()))], names=["digest", "s"])

    found = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
             .join(wanted.select("rep").distinct(), F.col("id").eqNullSafe(F.col("rep")), "left_semi").select("t")
             .mapInArrow(task, "digest binary, s array<long>"))
    sets = materialise(found.join(wanted.select("node", "digest"), "digest").select("node", "s").dropDuplicates(["node"]), "sets")
    # pairs of sets stay in the JVM: Arrow batches of rows this wide would take much memory
    both = F.size(F.array_intersect("x", "y"))
    links = materialise(pairs.select("a", "b").distinct().join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
                        .join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
                        .select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("n"))
                        .filter(100 * F.col("both") >= threshold * (F.col("n") - F.col("both"))).select("a", "b"), "links")
    for table in (wanted, sets, pairs):
        drop_table(table)
    return links


def _solve(docs: DataFrame, doc_id: str, text: str, threshold: int, k: int) -> DataFrame:
    """(id, h, n, component, component_id, class_id): a row per document; h: hash of the text,
    component: the component's smallest node, null without words."""
    bands = Bands(threshold)
    narrow_batches(docs.sparkSession)
    listings = materialise(document_listings(docs, doc_id, text, threshold, k).withColumn("row", F.monotonically_increasing_id()), "listings")
    classes = materialise(listings.filter("slot = 0 AND digest IS NOT NULL").groupBy("digest")
                          .agg(F.min("row").alias("node"), F.min("id").alias("rep")), "classes")
    light = materialise(listings.filter("slot = 0").select("id", "h", "n", "digest"), "documents")
    sketches = materialise(listings.filter("band IS NOT NULL").select("row", "n", "bits"), "sketches")
    # every listing with its node; m cells have shingles
    nodes = materialise(listings.filter("band IS NOT NULL").select("row", "digest", "n", "band", "d", "cells", F.size("keys").alias("m"))
                       .join(classes.select("digest", "node"), "digest").drop("digest"), "listing-nodes")

    by_key = Window.partitionBy("key")
    shared = (listings.select(F.explode("keys").alias("key"), "row").withColumn("size", F.count("*").over(by_key))
              .filter("size > 1"))
    shared = materialise(shared, "shared-keys")
    hot_cells = shared.filter(F.col("size") > HOT).groupBy("row").agg(F.count("*").alias("hot"))
    info = materialise(nodes.join(hot_cells, "row", "left").withColumn("useless", F.col("cells") - F.col("m") + F.coalesce("hot", F.lit(0))).drop("hot"),
                       "listing-nodes")
    needy = info.filter("cells - useless < d + 1")

    rows = shared.join(info.select("row", "node", "band", "useless", (F.col("cells") - F.col("d")).alias("agree")), "row")
    cold = rows.filter(F.col("size") <= HOT).groupBy("key", "node", "band").agg(F.min("agree").alias("agree"), F.max("useless").alias("useless"))
    pairs = (cold.alias("x").join(cold.alias("y"), "key").filter("x.node < y.node")
             .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.col("x.band").alias("band"))
             .agg(F.count("*").alias("same"), F.min(F.expr("x.agree - least(x.useless, y.useless)")).alias("least"))
             .filter("same >= least").select("a", "b", "band"))

    hot = (shared.filter(F.col("size") > HOT).join(needy.select("row", "node", "band"), "row").select("key", "node", "band")
           .union(listings.select("row", F.explode("empty").alias("key")).join(needy.select("row", "node", "band"), "row").select("key", "node", "band"))
           .distinct())
    hot = materialise(hot, "hot-keys")
    for table in (nodes, listings):
        drop_table(table)
    star = materialise(hot.join(hot.groupBy("key").agg(F.min("node").alias("a")), "key").filter("a < node")
                       .select("a", F.col("node").alias("b"), "band").distinct(), "stars")

    one_row = info.groupBy("node", "band").agg(F.min("row").alias("row"))

    def near(batches):
        for batch in batches:
            ok = []
            for x, y, n in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), batch.column("n").to_pylist()):
                h = np.bitwise_count(np.frombuffer(x, np.uint64 if len(x) % 8 == 0 else np.uint16) ^ np.frombuffer(y, np.uint64 if len(y) % 8 == 0 else np.uint16)).sum()
                ok.append(h <= bands.differ(n))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def of(side: str, out: str) -> DataFrame:
        return one_row.select(F.col("node").alias(side), "band", "row").join(sketches, "row").select(
            side, "band", F.col("n").alias(f"n_{side}"), F.col("bits").alias(out))

    pairs = (pairs.union(star).distinct().join(of("b", "y"), ["b", "band"]).join(of("a", "x"), ["a", "band"])
             .filter("100 * least(n_a, n_b) >= {} * greatest(n_a, n_b)".format(threshold))
             .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "x", "y").mapInArrow(near, "a long, b long"))
    pairs = materialise(pairs.distinct(), "pairs")
    drop_table(shared)
    links = _exact(pairs, docs, classes, doc_id, text, threshold, k)

    links = _hot_rest(sketches, hot, star, one_row, links, bands, lambda p: _exact(p, docs, classes, doc_id, text, threshold, k))
    labels = components(links)
    named = labels.join(classes, "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = (classes.join(labels, "node", "left").join(named, "component", "left")
                .select("digest", F.coalesce("component", "node").alias("component"),
                        F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("component_id")).alias("component_id"), F.col("rep").alias("class_id")))
    for table in (info, sketches, hot, star, links):
        drop_table(table)
    return (light.join(of_class, "digest", "left")
            .select("id", "h", "n", "component", *(F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col(c)).alias(c) for c in ("component_id", "class_id"))))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id): a row per document."""
    return _solve(docs, doc_id, text, threshold, k).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id", "class_id")


def _hot_rest(sketches, hot, star, one_row, links, bands, exact) -> DataFrame:
    """links and what is missing among listings that need hot keys: pairs of different components, in blocks."""
    if star.isEmpty():
        return links
    family = components(star.select("a", "b")).withColumnRenamed("component", "family")
    for closest in (True, False):
        labels = components(links)
        nodes = (hot.select("node", "band").distinct().join(family, "node").join(labels, "node", "left")
                 .withColumn("component", F.coalesce("component", "node")))
        size = (nodes.groupBy("family", "band").agg(F.count("*").alias("size"), F.min("component").alias("c0"), F.max("component").alias("c1"))
                .filter("c0 < c1").select("family", "band", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
        nodes = nodes.join(size, ["family", "band"]).join(one_row, ["node", "band"]).withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
        nodes = (nodes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
                 .join(sketches, "row").select("family", "band", "i", "j", "block", "node", "component", "n", "bits"))

        def compare(table: pa.Table) -> pa.Table:
            block, node, comp, n = (table.column(c).to_numpy() for c in ("block", "node", "component", "n"))
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint16).reshape(len(node), -1)
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            found = []
            for x in left:
                y = right[(comp[right] != comp[x]) & ((node[right] > node[x]) if i == j else True)]
                h = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)
                fit = h <= bands.differ(n[y] + n[x])
                y, h = y[fit], h[fit]
                if closest and len(y):
                    order = np.lexsort((h, comp[y]))
                    y = y[order][np.r_[True, np.diff(comp[y][order]) != 0]]
                found += [(min(node[x], node[z]), max(node[x], node[z])) for z in y]
            a, b = zip(*found) if found else ((), ())
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        pairs = materialise(nodes.groupBy("family", "band", "i", "j").applyInArrow(compare, "a long, b long").distinct(), "pairs")
        if pairs.isEmpty():
            break
        more, before = exact(pairs), links
        links = materialise(links.union(more).distinct(), "links")
        for table in (more, before, labels):
            drop_table(table)
    drop_table(family)
    return links


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and component of every document."""
    return jaccard_components(read_table(spark, sf_dir, "documents")).drop("class_id")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (nulls last), then of the
    smallest hash of the text.  Documents without a word link with nothing, so they stay.

    Only the rows to leave out are joined with the documents; they are the smaller part, and
    are broadcast by the planner only while their written size is small."""
    found = _solve(docs, doc_id, text, threshold, k).filter(F.col("component").isNotNull())
    rows = found.groupBy("component", "id", "h").agg(F.count("*").alias("copies"))
    first = F.struct(F.col("id").isNull().alias("x"), "id", "h")
    rows = materialise(rows.join(rows.groupBy("component").agg(F.min(first).alias("f")), "component")
                       .select("id", "h", "copies", (F.col("id").eqNullSafe(F.col("f.id")) & (F.col("h") == F.col("f.h"))).alias("stays"))
                       .filter("NOT stays OR copies > 1"), "left-out")

    def same(x: DataFrame):
        return docs[doc_id].eqNullSafe(x["id"]) & (F.xxhash64(docs[text]) == x["h"])

    twice = rows.filter("stays")
    out = docs.join(rows, same(rows), "left_anti")
    if not twice.isEmpty():  # rows that repeat id and text
        again = docs.join(twice, same(twice), "left_semi").withColumn("__h", F.xxhash64(f"`{text}`")).dropDuplicates([doc_id, "__h"]).drop("__h")
        out = out.unionByName(again)
    return out


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g FROM d),
n AS (SELECT doc_id, count(g) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = d.doc_id), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""
