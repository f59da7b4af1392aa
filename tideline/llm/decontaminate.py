"""Benchmark decontamination: find training documents that contain test items.

The test items are cut into segments of at most ``STRIDE`` words and put in a
BM25 inverted index.  Every training document is read as overlapping passages
of ``2 * STRIDE`` words, and *each passage is a query*: block-max WAND returns
every segment whose BM25 score reaches ``threshold`` of the score that the
segment has against itself.  Upper bounds are used in three steps: the sum of
the list maxima of a passage's terms (WAND stops there when no pivot exists),
the sum of the block maxima for each block of segments, and pivoting over the
postings within the blocks that are left.  All three are bounds, so nothing at
or above the threshold is lost.  A retrieved item is then verified: at least
``overlap`` of the distinct five-word shingles of its question *and* of its
answer must occur in the document (a part of fewer words counts as one shingle).

Words are ``\\w+`` of the lower-cased text.  Where the items bring no ``question`` /
``answer`` columns, the last sentence is taken for the answer.  That is a guess, so
such an item is also found by ``overlap`` of the shingles of its whole text, whatever
the overlaps of the two parts are.  Items of
fewer than ``MIN_ITEM_WORDS`` words have too few shingles to tell a likeness: they
are found where their whole word sequence occurs in a document, with score and overlaps 1.

Scale: the index is built from items only, never from training documents, in
shards of at most ``SHARD_BYTES`` of item text (the bound on what is broadcast);
a larger benchmark takes more passes over the documents, not a larger broadcast.
Documents are never shuffled.

Edge cases: a null or empty text has no passages and is clean; null items are
skipped; an item repeated under its own id counts once, under other ids it gives a
row each, as do repeated documents; an empty table on either side gives no rows (or
all documents kept); other columns are passed through or ignored whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.common import Shared, narrow_batches, text_slices, texts
from tideline.sources.tables import read_table

WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
TRIM = ".,;:!?\"'()"
STRIDE = 48
BLOCK = 8
SHINGLE = 5
MIN_ITEM_WORDS = 8
SHARD_BYTES = 16 << 20
MAX_CACHED_TOKENS = 120_000


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(ws: list[str], k: int = SHINGLE) -> set[tuple[str, ...]]:
    if not ws:
        return set()
    return {tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))}


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the last of several sentences is the answer."""
    parts = [p for p in SENTENCE_END.split(text.strip()) if WORD.search(p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


class SegmentIndex:
    """BM25 postings of item segments, scores divided by the segment's own score."""

    def __init__(self, items: list[tuple], k1: float = 1.2, b: float = 0.75, guessed: bool = False):
        """items: (item_id, question, answer); guessed: the parts are a guess, the whole text counts too."""
        self.items, segments = [], []
        self.short: dict[tuple[str, ...], list] = defaultdict(list)  # word sequence: its items, and whether they have an answer
        for item_id, question, answer in items:
            q, a = words(question or ""), words(answer or "")
            ws = q + a
            if len(ws) < MIN_ITEM_WORDS:
                if ws:
                    self.short[tuple(ws)].append((item_id, 1.0 if a else None))
                continue
            n = math.ceil(len(ws) / STRIDE)
            cuts = [len(ws) * i // n for i in range(n + 1)]
            segments += [(len(self.items), ws[x:y]) for x, y in zip(cuts, cuts[1:])]
            whole = {g: g for g in shingles(ws)} if guessed else {}  # the parts share its tuples in the broadcast
            self.items.append((item_id, *({whole.get(g, g) for g in shingles(x)} for x in (q, a)), set(whole)))
        self.item_of = [i for i, _ in segments]
        self.vocab: dict[str, int] = {}
        n, mean = len(segments), max(1.0, sum(len(ws) for _, ws in segments) / max(1, len(segments)))
        df = Counter(w for _, ws in segments for w in set(ws))
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for s, (_, ws) in enumerate(segments):
            tf = Counter(ws)
            score = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * f * (k1 + 1)
                     / (f + k1 * (1 - b + b * len(ws) / mean)) for w, f in tf.items()}
            own = sum(score.values())
            for w, x in score.items():
                postings[self.vocab.setdefault(w, len(self.vocab))].append((s, x / own))
        # CSR by (term, block); segments ascend within a term
        self.blk_ptr, self.blk_id, self.blk_max, self.post_ptr, self.seg, self.imp = [0], [], [], [0], [], []
        for t in range(len(self.vocab)):
            for s, x in postings[t]:
                if len(self.blk_id) == self.blk_ptr[-1] or self.blk_id[-1] != s // BLOCK:
                    self.blk_id.append(s // BLOCK)
                    self.blk_max.append(0.0)
                    self.post_ptr.append(self.post_ptr[-1])
                self.blk_max[-1] = max(self.blk_max[-1], x)
                self.post_ptr[-1] += 1
                self.seg.append(s)
                self.imp.append(x)
            self.blk_ptr.append(len(self.blk_id))
        self.n_blocks = n // BLOCK + 1
        self.blk_ptr, self.blk_id = np.array(self.blk_ptr, np.int64), np.array(self.blk_id, np.int64)
        self.blk_max = np.array(self.blk_max, np.float64)
        self.list_max = (np.maximum.reduceat(self.blk_max, self.blk_ptr[:-1]) if len(self.vocab)
                         else np.zeros(0))

    def in_block(self, entries: list[int], theta: float) -> list[tuple[int, float]]:
        """WAND over the postings of some terms within one block: (segment, score) of at least theta."""
        cursors = [[self.seg[self.post_ptr[e]], self.post_ptr[e], self.post_ptr[e + 1], self.blk_max[e]] for e in entries]
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[3]
                if bound >= theta:
                    pivot = i
                    break
            if pivot < 0:
                break
            at = cursors[pivot][0]
            if cursors[0][0] == at:
                hits = [c for c in cursors if c[0] == at]
                score = sum(self.imp[c[1]] for c in hits)
                if score >= theta:
                    out.append((at, score))
                to = at + 1
            else:
                hits, to = cursors[:pivot], at
            for c in hits:
                while c[1] < c[2] and self.seg[c[1]] < to:
                    c[1] += 1
                c[0] = self.seg[c[1]] if c[1] < c[2] else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def search(self, passage: np.ndarray, term: np.ndarray, theta: float) -> list[tuple[int, int, float]]:
        """All (passage, segment, score >= theta).  passage/term: distinct pairs, sorted by passage."""
        if not len(passage):
            return []
        theta -= 1e-9
        start = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        size = np.diff(np.r_[start, len(passage)])
        live = np.repeat(np.add.reduceat(self.list_max[term], start) >= theta, size)
        passage, term = passage[live], term[live]
        if not len(passage):
            return []
        n = self.blk_ptr[term + 1] - self.blk_ptr[term]
        entry = np.repeat(self.blk_ptr[term] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        key = np.sort((np.repeat(passage, n) * self.n_blocks + self.blk_id[entry]) * len(self.blk_id) + entry)
        key, entry = key // len(self.blk_id), key % len(self.blk_id)
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        bound = np.add.reduceat(self.blk_max[entry], start)
        end = np.r_[start[1:], len(key)]
        return [(int(key[a] // self.n_blocks), s, x) for a, b in zip(start[bound >= theta], end[bound >= theta])
                for s, x in self.in_block(entry[a:b].tolist(), theta)]


class _TermIds(dict):
    """Raw token -> term id, -1 for one word outside the index, or below -1 an entry of ``several``."""

    def __init__(self, vocab: dict[str, int]):
        self.vocab, self.several = vocab, []

    def __missing__(self, token: str) -> int:
        if len(self) > MAX_CACHED_TOKENS:
            self.clear()
        word = token.lower().strip(TRIM)
        ids = [self.vocab.get(w, -1) for w in ((word,) if word.isalnum() else WORD.findall(word))]
        if len(ids) == 1:
            x = ids[0]
        else:
            self.several.append(ids)
            x = -1 - len(self.several)
        self[token] = x
        return x


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class LeakFinder:
    """Matches texts against one index shard; lives in a Python worker."""

    def __init__(self, index: SegmentIndex, threshold: float, overlap: float):
        self.index, self.threshold, self.overlap = index, threshold, overlap
        self.ids = _TermIds(index.vocab)
        self.sizes: dict[str, set[int]] = defaultdict(set)  # first word of short items: how many words they have
        for ws in index.short:
            self.sizes[ws[0]].add(len(ws))

    def _terms(self, text: str) -> np.ndarray:
        tokens = text.split()
        a = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        if len(a) and a.min() < -1:
            a = np.array([y for x in a.tolist() for y in ((x,) if x >= -1 else self.ids.several[-2 - x])], np.int64)
        if len(self.ids) > MAX_CACHED_TOKENS or len(self.ids.several) > MAX_CACHED_TOKENS:
            self.ids = _TermIds(self.index.vocab)
        return a

    def find_short(self, batch: list[str]) -> list[tuple[int, object, int, float, float, float | None]]:
        """As ``find``, for items of few words: where their sequence occurs first."""
        out = []
        for row, text in enumerate(batch if self.sizes else ()):
            ws, first = words(text), {}
            for i, w in enumerate(ws):
                for n in self.sizes.get(w, ()):
                    if (seq := tuple(ws[i:i + n])) in self.index.short:
                        first.setdefault(seq, i)
            out += [(row, item_id, i, 1.0, 1.0, answer) for seq, i in first.items() for item_id, answer in self.index.short[seq]]
        return out

    def find(self, batch: list[str]) -> list[tuple[int, object, int, float, float, float | None]]:
        """(row, item_id, first word of the best passage, score, question overlap, answer overlap)."""
        out, n_terms = self.find_short(batch), len(self.index.vocab)
        if not n_terms:
            return out
        keys, base, first = [], 0, []
        for text in batch:
            a = self._terms(text)
            first.append(base)
            at = np.flatnonzero(a >= 0)
            keys.append((at // STRIDE + base) * n_terms + a[at])
            base += max(2, -(-len(a) // STRIDE))  # passage i: the halves i and i + 1 of one text
        key = _distinct(np.concatenate(keys))
        half, term = key // n_terms, key % n_terms
        # the list maxima of a passage are at most those of its two halves together
        bound = np.bincount(half, self.index.list_max[term], minlength=base + 1)
        row_of = np.array(first)
        live = bound[:-1] + bound[1:] >= self.threshold - 1e-9
        live[row_of[1:] - 1] = False  # the last half of a text starts no passage
        live[base - 1:] = False
        mine, before = live[half], (half > 0) & live[half - 1]
        key = _distinct(np.r_[key[mine], key[before] - n_terms])
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for passage, seg, score in self.index.search(key // n_terms, key % n_terms, self.threshold):
            row = int(np.searchsorted(row_of, passage, "right")) - 1
            k = (row, self.index.item_of[seg])
            best[k] = max(best.get(k, (-1.0, 0)), (score, -(passage - first[row]) * STRIDE))
        grams, last = set(), None
        for (row, item), (score, at) in sorted(best.items()):
            if row != last:
                ws, last = words(batch[row]), row
                grams = shingles(ws)
                short: dict[int, set] = {}
            item_id, q, a, whole = self.index.items[item]

            def part(g):
                if not g:
                    return None
                k = len(next(iter(g)))
                if k != SHINGLE and k not in short:
                    short[k] = shingles(ws, k)
                return len(g & (grams if k == SHINGLE else short[k])) / len(g)

            pq, pa_ = part(q), part(a)
            if all(x is None or x >= self.overlap for x in (pq, pa_)) or whole and part(whole) >= self.overlap:
                out.append((row, item_id, -at, score, pq if pq is not None else 0.0, pa_))
        return out


def _index_shards(items: DataFrame, item_id: str, text: str, question: str | None, answer: str | None):
    """Index of each shard of the items; a shard's text is bounded by about SHARD_BYTES."""
    if question:
        d = items.select(F.col(item_id).alias("id"), F.col(question).alias("q"),
                         (F.col(answer) if answer else F.lit("")).cast("string").alias("a"))
    else:
        d = items.select(F.col(item_id).alias("id"), F.col(text).alias("q"), F.lit(None).cast("string").alias("a"))
    d = d.filter(F.col("q").isNotNull() | F.col("a").isNotNull()).distinct()
    size = d.agg(F.sum(F.length(F.coalesce("q", F.lit(""))) + F.length(F.coalesce("a", F.lit(""))))).first()[0] or 0
    n = max(1, math.ceil(4 * size / SHARD_BYTES))
    for i in range(n):
        rows = d.filter(F.pmod(F.xxhash64("id", "q", "a"), F.lit(n)) == i).collect() if n > 1 else d.collect()
        rows.sort(key=lambda r: (r[0] is None, str(r[0]), r[1] or ""))
        yield SegmentIndex([(r[0], *(split_item(r[1] or "") if not question else (r[1], r[2]))) for r in rows], guessed=not question)


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", question: str | None = None, answer: str | None = None,
               threshold: float = 0.5, overlap: float = 0.8) -> DataFrame:
    """One row per document and test item that it contains:
    (doc_id, item_id, passage_start, score, question_overlap, answer_overlap)."""
    spark = docs.sparkSession
    narrow_batches(spark)
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, items.schema[item_id].dataType),
                           T.StructField("passage_start", T.LongType()), T.StructField("score", T.DoubleType()),
                           T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())])
    slim, out = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), None
    id_type, names = _arrow_type(items.schema[item_id].dataType), [f.name for f in schema]
    for index in _index_shards(items, item_id, item_text, question, answer):
        shared = Shared(spark, index)

        def task(batches, shared=shared):
            finder = LeakFinder(shared.value, threshold, overlap)
            for batch in text_slices(batches, "text"):
                if hits := finder.find(texts(batch, "text")):
                    cols = list(zip(*hits))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], id_type),
                         *(pa.array(c, k) for c, k in zip(cols[2:], (pa.int64(), pa.float64(), pa.float64(), pa.float64())))],
                        names=names)

        part = slim.mapInArrow(task, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  question: str | None = None, answer: str | None = None,
                  threshold: float = 0.5, overlap: float = 0.8) -> DataFrame:
    """The documents (all columns, any) that contain no test item."""
    spark = docs.sparkSession
    narrow_batches(spark)
    for index in _index_shards(items, item_id, item_text, question, answer):
        shared = Shared(spark, index)

        def task(batches, shared=shared):
            finder = LeakFinder(shared.value, threshold, overlap)
            for batch in text_slices(batches, text):
                keep = np.ones(batch.num_rows, bool)
                for hit in finder.find(texts(batch, text)):
                    keep[hit[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(task, docs.schema)
    return docs


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
