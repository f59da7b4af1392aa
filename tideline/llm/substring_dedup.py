"""Removal of word passages that occur earlier in the corpus.

A window is ``WINDOW`` consecutive words of one document (words are runs of characters other
than blanks, tabs and line ends).  A word goes if a window that covers it has the same words as
a window of a document with a smaller id, or as one that starts earlier in the same document.
Windows are judged on the input.

Method: FM-indexes per shard, matching statistics
1. *Stretches.*  Every window has an anchor: its run of ``GRAM`` words of smallest hash (the
   leftmost of equal ones).  Windows of equal words have equal anchors at the same place, so
   consecutive windows with one anchor form a stretch, and only stretches of equal
   anchors can share a window.  A stretch is told by its anchor's hash and its own.
2. *Copies are combined.*  An anchor that occurs once has no repeated window.  Of equal
   stretches only the first is looked at further; all windows of the others go.  Where an
   anchor has one stretch only, that is all.
3. *Index.*  The first stretches of the other anchors are dealt to shards by anchor.  A shard
   concatenates its stretches, in document order, to a text of word numbers and builds its
   Burrows-Wheeler transform from suffixes sorted as deep as a window; the index is a
   wavelet matrix of it: bit-packed levels with a count per 64 bits.
4. *Matching statistics.*  All windows' ends of the shard's stretches are searched backward
   together, a word a step.  An end stays while its suffix occurs a second time; the number of steps is
   its matching statistic.  Ends that reach ``WINDOW`` are windows that occur several times: equal
   intervals of the index are equal windows, the first in document order stays, the others are reported.
5. *Hot anchors* (over ``HOT`` different stretches: a phrase shorter than a window that very many
   documents share) would make a shard of any size.  Their stretches are cut into single windows,
   which are grouped by a hash of all their words.

Equal words are told by 64-bit hashes in 1, 2 and 5, and by the words themselves in 3 and 4.

Scale: texts are shuffled once, for the documents that have a repeated stretch, and those of
them with stretches to search once more.  Anchors (about one in seven words) are counted and joined by their hash; a very frequent one
is combined before the shuffle, and the join's skew is Spark's to split.  A shard holds about
``SHARD_WORDS`` words.

Edge cases: null and empty texts have no words, and keep the hash of the empty text; documents shorter than a window stay.  A
null id comes after all others.  Rows that repeat id and text are one document; rows of equal id and other
text are documents of which none is earlier.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.llm.common import drop_table, materialise, mix64, narrow_batches, raw_texts, text_slices
from tideline.sources.tables import read_table

WINDOW = 20
GRAM = 6
#: Different stretches of an anchor that a shard takes.
HOT = 2_000
SHARD_WORDS = 400_000
MAX_CACHED_WORDS = 120_000
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_MASK = (1 << 64) - 1


# ---- stretches -------------------------------------------------------------------------------------------------

class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_CACHED_WORDS:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word)
        return x


class SpanHashes:
    """Hashes of any span of a text's words, from sums of word hashes times powers of an odd number."""

    def __init__(self):
        self.up, self.down = self._powers(1024)

    @staticmethod
    def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)

    def __call__(self, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        if len(words) >= len(self.up):
            self.up, self.down = self._powers(2 * len(words))
        upto = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.down[:len(words)], out=upto[1:])
        return mix64((upto[start + length] - upto[start]) * self.up[start] + length.astype(np.uint64))


def word_hashes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def stretches(a: np.ndarray, spans: SpanHashes, window: int, gram: int):
    """(anchor's hash, stretch's hash, first window, windows, whether the stretch stood earlier in the text)."""
    n, width = len(a), window - gram + 1
    g = a[:n - gram + 1].copy()
    for i in range(1, gram):
        g = g * np.uint64(_BASE) + a[i:n - gram + 1 + i]
    g = mix64(g)
    # the position breaks ties of the upper half, so that the leftmost is taken
    low = (g & np.uint64(_MASK ^ 0xFFFFFFFF)) | np.arange(len(g), dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        low, step = np.minimum(low[:-step], low[step:]), step * 2
    if step < width:
        low = np.minimum(low[:len(low) - (width - step)], low[width - step:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.r_[first, len(at)])
    anchor, own = g[at[first]], spans(a, first, count + window - 1)
    again = np.ones(len(first), bool)
    again[np.unique(own, return_index=True)[1]] = False
    return anchor.view(np.int64), own.view(np.int64), first, count, again


def _pack(first, count, again):
    return first << 6 | count << 1 | again


def _flat(column: str = "at") -> list[Column]:
    return [F.shiftright(column, 6).alias("first"), F.shiftright(column, 1).bitwiseAND(31).alias("count")]


def _lists(values: list[np.ndarray], kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in values])].astype(np.int32)),
                                    pa.array(np.concatenate(values) if values else np.zeros(0, kind)))


def document_stretches(docs: DataFrame, doc_id: str, text: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, h, n, digest, anchor, own, at): a row per document; h: hash of the text, digest: SHA-256 of its words,
    joined by spaces; anchor, own, at: its stretches."""
    if not 0 < window - gram + 1 < 32:
        raise ValueError("a window has at most 31 runs of `gram` words")

    def task(batches):
        hashes, spans, none = WordHashes(), SpanHashes(), np.zeros(0, np.int64)
        for batch in text_slices(batches, "t"):
            n, digest, found = [], [], []
            for raw in raw_texts(batch, "t"):
                ws = raw.split()
                n.append(len(ws))
                digest.append(hashlib.sha256(b" ".join(ws)).digest())
                if len(ws) < window:
                    found.append((none, none, none))
                else:
                    anchor, own, *where = stretches(word_hashes(ws, hashes), spans, window, gram)
                    found.append((anchor, own, _pack(*where)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("h"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), *(_lists(list(x), np.int64) for x in zip(*found))],
                names=["id", "h", "n", "digest", "anchor", "own", "at"])

    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("t")).mapInArrow(
        task, f"id {docs.schema[doc_id].dataType.simpleString()}, h long, n long, digest binary, anchor array<long>, own array<long>, at array<long>")


# ---- index -----------------------------------------------------------------------------------------------------

class WaveletMatrix:
    """Rank queries over a sequence of small numbers: a level per bit, packed, with a count before each 64 bits."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.n, self.levels = len(values), []
        for level in reversed(range(max(1, (symbols - 1).bit_length()))):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((level, words, before, len(values) - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, words, before, zeros in self.levels:
            word = i >> 6
            ones = before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where(symbol >> level & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, i) - self.base[symbol]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes sorted by their first ``depth`` symbols at least."""
    rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while step < depth and step < len(text):
        behind = np.zeros_like(rank)
        behind[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(text) + 1) + behind, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Index of a text of numbers below ``symbols`` for patterns of up to ``depth``; the text's order itself isn't kept."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.n = len(text)
        self.bwt = WaveletMatrix(text[suffix_order(text, depth) - 1], symbols)
        self.smaller = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))[:-1]]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one symbol more in front."""
        both = self.smaller[np.r_[symbol, symbol]] + self.bwt.rank(np.r_[symbol, symbol], np.r_[low, high])
        return both[:len(symbol)], both[len(symbol):]

    def matching_statistics(self, text: np.ndarray, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each end in ``text``: length, up to ``most``, of its longest suffix that the index has twice or more;
        the start of that suffix's interval.  The text has no separator within ``most`` symbols of an end."""
        length, start = np.zeros(len(end), np.int64), np.zeros(len(end), np.int64)
        live, low, high = np.arange(len(end)), np.zeros(len(end), np.int64), np.full(len(end), self.n, np.int64)
        for step in range(1, most + 1):
            low, high = self.extend(text[end[live] - step], low, high)
            more = high - low > 1
            live, low, high = live[more], low[more], high[more]
            length[live], start[live] = step, low
            if not len(live):
                break
        return length, start


def repeated_windows(order: np.ndarray, doc: np.ndarray, texts: list[bytes], first: np.ndarray, window: int):
    """(stretch, first window, windows): runs of windows whose words occur earlier.  order: rank of each stretch's
    document id, doc: its document, texts: its words, joined by spaces, first: its first word in the document."""
    by = np.lexsort((first, doc, order))
    order, doc, first = order[by], doc[by], first[by]
    words = [texts[i].split(b" ") for i in by]
    size = np.array([len(w) for w in words])
    # numbers from 1 on for the words, 0 behind every stretch
    number: dict[bytes, int] = {}
    text = np.zeros(int(size.sum()) + len(words), np.int64)
    at = np.cumsum(size + 1) - size - 1
    place = np.arange(int(size.sum())) + np.repeat(np.arange(len(words)), size)
    text[place] = np.fromiter((number.setdefault(w, len(number) + 1) for ws in words for w in ws), np.int64, len(place))
    windows = size - window + 1
    stretch = np.repeat(np.arange(len(words)), windows)
    nth = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = at[stretch] + nth
    length, interval = FMIndex(text, len(number) + 1, window).matching_statistics(text, start + window, window)
    found = np.flatnonzero(length == window)
    found = found[np.lexsort((start[found], interval[found]))]
    s, new = stretch[found], np.r_[True, np.diff(interval[found]) != 0][:len(found)]
    lead = found[np.maximum.accumulate(np.where(new, np.arange(len(found)), 0))] if len(found) else found
    earlier = order[stretch[lead]] < order[s]
    earlier[1:] |= ~new[1:] & (doc[s[1:]] == doc[s[:-1]])
    gone = np.sort(found[earlier])
    s, k = stretch[gone], nth[gone]
    head = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (k[1:] != k[:-1] + 1)][:len(gone)])
    return by[s[head]], first[s[head]] + k[head], np.diff(np.r_[head, len(gone)])


# ---- the corpus ------------------------------------------------------------------------------------------------

def _later(first: str) -> Column:
    """Whether the row's id comes after the smallest (null: none), nulls last, or its stretch stood earlier in its text."""
    return F.coalesce(F.col("id") > F.col(first), F.col("id").isNull() & F.col(first).isNotNull()) | (F.col("at").bitwiseAND(1) == 1)


def _cut_out(texts: DataFrame, window: int, id_type: str) -> DataFrame:
    """The stretches to search (h: hot ones, as windows) of (row, id, t, seek)."""

    def task(batches):
        hashes, spans = WordHashes(), SpanHashes()
        for batch in text_slices(batches, "t"):
            out = []
            for i, (raw, seek) in enumerate(zip(raw_texts(batch, "t"), batch.column("seek").to_pylist())):
                ws, seen = raw.split(), set()
                hot = [s["first"] + k for s in seek if s["hot"] for k in range(s["count"])]
                if hot:
                    at = np.array(sorted(set(hot)))
                    for own, first in zip(spans(word_hashes(ws, hashes), at, np.full(len(at), window)).view(np.int64).tolist(), at.tolist()):
                        out.append((i, own, first, 1, None, own in seen))
                        seen.add(own)
                for s in seek:
                    if not s["hot"]:
                        a = s["first"]
                        out.append((i, s["anchor"], a, s["count"], b" ".join(ws[a:a + s["count"] + window - 1]), False))
            c = list(zip(*out)) or [()] * 6
            take = pa.array(c[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(take), batch.column("id").take(take), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                 pa.array(c[3], pa.int64()), pa.array(c[4], pa.binary()), pa.array(c[5], pa.bool_())],
                names=["row", "id", "anchor", "first", "count", "words", "again"])

    return texts.mapInArrow(task, f"row long, id {id_type}, anchor long, first long, count long, words binary, again boolean")


@dataclass(frozen=True)
class Repeats:
    """``documents``: (id, h, n, digest), a row per row of the input; ``whole``: (row, id, h) of documents that go
    as a whole; ``texts``: (row, id, h, t, gone, seek) of others with repeated stretches; ``found``: (row, more)."""

    documents: DataFrame
    whole: DataFrame
    texts: DataFrame
    found: DataFrame


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> Repeats:
    """All runs of windows that occur earlier: (first, count) in ``gone`` and ``more``."""
    narrow_batches(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType.simpleString()
    all_ = materialise(document_stretches(docs, doc_id, text, window, gram).withColumn("row", F.monotonically_increasing_id()), "stretches")
    light = materialise(all_.select("row", "id", "h", "n", "digest"), "documents")
    # rows that repeat id and text: the first of them stands for all
    key = [F.col("id").eqNullSafe(F.col("i2")), F.col("h") == F.col("h2")]
    twice = light.groupBy("id", "h").agg(F.min("row").alias("low"), F.count("*").alias("c")).filter("c > 1").select(F.col("id").alias("i2"), F.col("h").alias("h2"), "low")
    spare = materialise(light.join(twice, key).filter("row <> low").select("row"), "repeated-rows")
    each = all_.join(spare, "row", "left_anti")
    flat = each.select("row", "id", F.explode(F.arrays_zip("anchor", "own", "at")).alias("s")).select("row", "id", "s.*")

    often = (flat.groupBy("anchor").agg(F.count("*").alias("c"), F.min("own").alias("o1"), F.max("own").alias("o2"), F.min("id").alias("lowest"))
             .filter("c > 1").select("anchor", (F.col("o1") == F.col("o2")).alias("one"), "lowest"))
    often = materialise(often, "anchors")
    same = materialise(flat.join(often, "anchor"), "candidates")
    for table in (often, all_):
        drop_table(table)
    several = same.filter("NOT one").drop("lowest")
    several = materialise(several.join(several.groupBy("anchor", "own").agg(F.min("id").alias("lowest")), ["anchor", "own"]), "candidates")
    copies = same.filter("one").filter(_later("lowest")).select("row", *_flat()).union(several.filter(_later("lowest")).select("row", *_flat()))
    firsts = several.filter(~_later("lowest")).select("anchor", "row", *_flat())
    hot = materialise(firsts.groupBy("anchor").agg(F.count("*").alias("c")).filter(F.col("c") > HOT).select("anchor", F.lit(True).alias("hot")), "hot-anchors")
    firsts = firsts.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))

    none = F.lit(None)
    marks = (copies.select("row", F.struct("first", "count").alias("gone"), none.cast("struct<anchor:long,first:long,count:long,hot:boolean>").alias("seek"))
             .union(firsts.select("row", none.cast("struct<first:long,count:long>"), F.struct("anchor", "first", "count", "hot"))))
    marks = (marks.groupBy("row").agg(F.collect_list("gone").alias("gone"), F.collect_list("seek").alias("seek"))
             .join(light.select("row", "id", "h", "n"), "row"))
    marks = materialise(marks.withColumn("whole", F.aggregate("gone", F.lit(0).cast("long"), lambda s, x: s + x["count"]) == F.col("n") - (window - 1)), "marks")
    for table in (same, several):
        drop_table(table)
    whole = marks.filter("whole").select("row", "id", "h")
    part = marks.filter("NOT whole AND (size(gone) > 0 OR size(seek) > 0)").select("row", F.col("id").alias("i2"), F.col("h").alias("h2"), "gone", "seek")
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    texts = materialise(texts.join(part, key).drop("i2", "h2"), "texts")

    pieces = materialise(_cut_out(texts.filter("size(seek) > 0").select("row", "id", "t", "seek"), window, id_type).distinct(), "pieces")
    by_window = pieces.filter("words IS NULL").select("row", "id", "anchor", F.col("first"), F.col("again").cast("long").alias("at"))
    hot_found = (by_window.join(by_window.groupBy("anchor").agg(F.min("id").alias("lowest")), "anchor").filter(_later("lowest"))
                 .select("row", "first", F.lit(1).cast("long").alias("count")))
    total = pieces.filter("words IS NOT NULL").agg(F.sum(F.col("count") + (window - 1))).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_WORDS))

    def search(table: pa.Table) -> pa.Table:
        rank = pc.rank(table.column("id").combine_chunks(), null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
        row = table.column("row").to_numpy()
        which, first, count = repeated_windows(rank, row, table.column("words").to_pylist(), table.column("first").to_numpy(), window)
        return pa.table({"row": pa.array(row[which], pa.int64()), "first": pa.array(first, pa.int64()), "count": pa.array(count, pa.int64())})

    indexed = (pieces.filter("words IS NOT NULL").select(F.pmod(F.hash("anchor"), F.lit(shards)).alias("shard"), "row", "id", "first", "words")
               .groupBy("shard").applyInArrow(search, "row long, first long, count long"))
    found = materialise(indexed.union(hot_found).groupBy("row").agg(F.collect_list(F.struct("first", "count")).alias("more")), "found")
    return Repeats(light, whole, texts, found)


def _covered(n: int, runs: list, window: int) -> np.ndarray:
    """Which of n words lie in the windows of the runs (first, count)."""
    edge = np.zeros(n + 1, np.int64)
    if runs:
        first, count = np.array([r["first"] for r in runs]), np.array([r["count"] for r in runs])
        np.add.at(edge, first, 1)
        np.add.at(edge, first + count + window - 1, -1)
    return np.cumsum(edge[:n]) > 0


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, changed, kept): a row per document; kept: the words that stay, joined
    by spaces, where some go (null: all stay)."""
    r = repeats(docs, doc_id, text, window, gram)
    id_type = docs.schema[doc_id].dataType.simpleString()
    parts = r.texts.join(r.found, "row", "left").select("id", "h", "t", "gone", "more")

    def task(batches):
        for batch in text_slices(batches, "t"):
            removed, digest, kept = [], [], []
            for raw, gone, more in zip(raw_texts(batch, "t"), batch.column("gone").to_pylist(), batch.column("more").to_pylist()):
                ws = raw.split()
                out = _covered(len(ws), gone + (more or []), window)
                left = b" ".join([ws[i] for i in np.flatnonzero(~out)])
                removed.append(int(out.sum()))
                digest.append(hashlib.sha256(left).digest())
                kept.append(left.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), pa.array(removed, pa.int64()), pa.array(digest, pa.binary()), pa.array(kept, pa.string())],
                                             names=["id", "h", "removed", "left", "kept"])

    changed = parts.mapInArrow(task, f"id {id_type}, h long, removed long, left binary, kept string")
    changed = changed.filter("removed > 0").unionByName(
        r.whole.select("id", "h", F.lit(None).cast("long").alias("removed"), F.unhex(F.sha2(F.lit(""), 256)).alias("left"), F.lit("").alias("kept")))
    # rows that repeat id and text have the same answer
    changed = changed.groupBy("id", "h").agg(F.min("removed").alias("removed"), F.min("left").alias("left"), F.min("kept").alias("kept"))
    changed = changed.select(F.col("id").alias("i2"), F.col("h").alias("h2"), F.coalesce("removed", F.lit(-1)).alias("removed"), "left", "kept")
    out = r.documents.join(changed, [F.col("id").eqNullSafe(F.col("i2")), F.col("h") == F.col("h2")], "left")
    removed = F.when(F.col("removed") < 0, F.col("n")).otherwise(F.coalesce("removed", F.lit(0).cast("long")))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_words"), removed.alias("n_removed"),
                      F.lower(F.hex(F.coalesce("left", "digest"))).alias("kept_sha256"), F.col("removed").isNotNull().alias("changed"), "kept")


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that an earlier passage of 20 words repeats."""
    return without_repeats(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
c AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM g) WHERE place > 1),
r AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM c) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(js), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda i: NOT list_contains(js, i))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""
