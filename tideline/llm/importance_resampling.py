"""Importance resampling of documents towards a target text set.

A document's features are all runs of one to three consecutive words (ASCII letters
lower-cased; words are runs of ``[0-9a-z]`` and of characters above 0x7F), hashed to
``BUCKETS`` buckets by the CRC-32 of their UTF-8 bytes.  With s of the corpus's S
features and t of the target's T features in a bucket, the bucket's gain is
floor(1000 * ln((t + 1) (S + B) / ((s + 1) (T + B)))).  A document weighs the sum of
its features' gains; Gumbel noise drawn from its id is added, and the highest scores
are the sample (sampling without replacement in proportion to exp(weight / 1000)).

Method: position-table CRC
1. CRC-32 is linear over XOR: a byte's contribution to the register depends only on the
   byte and on how many bytes follow it.  ``CONTRIBUTION`` holds it for every byte value
   and every distance from the end below ``BLOCK``.
2. A slice of texts becomes one buffer of words, each followed by one space, so that every
   feature is a span of it.  The spans' bytes are looked up by (distance from the span's
   end, byte) and XORed together by ``bitwise_xor.reduceat``; a constant for the span's
   length stands for the register's start value.
3. Longer spans are cut into blocks from their end.  The blocks are looked up alike, and
   folded: the register is moved over a block by four look-ups of its own bytes.

Scale: texts are read twice and never shuffled.  A task emits at most ``BUCKETS`` counts; the
gains are a table of ``BUCKETS`` numbers, which goes to the tasks.  Scores are ranked by a
range partitioning with a count per partition, so no task orders all of them.

Edge cases: null and empty texts have no features and weight 0; documents under ``MIN_WORDS``
words aren't drawn.  A null id hashes as an empty text and loses ties; repeated rows
are documents of their own with consecutive ranks.  Without documents there are no rows; without
target texts t and T are 0.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.llm.common import drop_table, materialise, narrow_batches, raw_texts, text_slices
from tideline.sources.tables import read_table

BUCKETS = 10_000
MIN_WORDS = 20
MAX_RUN = 3
SEED = 42
#: Distances from a span's end in the table; longer spans are folded.
BLOCK = 64
#: Span bytes looked up at once.
CHUNK_BYTES = 1 << 20
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)


def _contributions(block: int) -> np.ndarray:
    """(block, 256): register after a byte and so many zero bytes, started at zero."""
    last = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        last = np.where(last & 1, (last >> 1) ^ np.uint32(_POLYNOMIAL), last >> 1).astype(np.uint32)
    table = np.empty((block, 256), np.uint32)
    table[0] = last
    for d in range(1, block):
        table[d] = (table[d - 1] >> np.uint32(8)) ^ last[table[d - 1] & np.uint32(255)]
    return table


def _lengths(block: int) -> np.ndarray:
    """Register after 0..block zero bytes, started at its usual value."""
    return np.array([zlib.crc32(bytes(n)) for n in range(block + 1)], np.uint32) ^ _ONES


CONTRIBUTION = _contributions(BLOCK)
LENGTH = _lengths(BLOCK)


def _over_block(register: np.ndarray) -> np.ndarray:
    """The registers moved over a block of zero bytes."""
    out = np.zeros_like(register)
    for j in range(4):
        out ^= CONTRIBUTION[BLOCK - 1 - j][(register >> np.uint32(8 * j)) & np.uint32(255)]
    return out


def _block_values(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XOR of the byte contributions of spans of 1 to BLOCK bytes."""
    out = np.empty(len(start), np.uint32)
    table = CONTRIBUTION.ravel()
    upto = np.cumsum(length)
    a = 0
    while a < len(start):
        before = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, before + CHUNK_BYTES, "right")))
        n, first = length[a:b], upto[a:b] - length[a:b] - before
        step = np.arange(int(n.sum()), dtype=np.int64)
        byte = buf[step + np.repeat(start[a:b] - first, n)]
        after = np.repeat(first + n - 1, n) - step
        out[a:b] = np.bitwise_xor.reduceat(table[(after << 8) + byte], first)
        a = b
    return out


def span_crcs(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans (all of one byte or more) of a byte buffer."""
    blocks = -(-length // BLOCK)
    if len(start) == 0 or blocks.max() == 1:
        return _block_values(buf, start, length) ^ LENGTH[length] ^ _ONES
    # all blocks of all spans: the first one is short, the others are full
    at = np.cumsum(blocks) - blocks
    span = np.repeat(np.arange(len(start)), blocks)
    nth = np.arange(len(span)) - at[span]
    head = length - (blocks - 1) * BLOCK
    size = np.where(nth == 0, head[span], BLOCK)
    value = _block_values(buf, start[span] + np.where(nth == 0, 0, head[span] + (nth - 1) * BLOCK), size)
    out = value[at] ^ LENGTH[head]
    by_blocks = np.argsort(-blocks, kind="stable")
    open_ = len(by_blocks) - np.searchsorted(blocks[by_blocks][::-1], np.arange(1, blocks.max()), "right")
    for k, n in enumerate(open_, 1):
        these = by_blocks[:n]
        out[these] = _over_block(out[these]) ^ value[at[these] + k]
    return out ^ _ONES


#: Bytes of words; ASCII letters are lower-cased, all other bytes become spaces.
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def features(raw: list[bytes], buckets: int, max_run: int = MAX_RUN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text's index, bucket) of all features, run length by run length, after (index of each word, None)."""
    data = np.frombuffer(b" ".join(raw).translate(_WORD_BYTES) + b" ", np.uint8)
    word = data != 0x20
    edge = np.diff(word.astype(np.int8), prepend=np.int8(0))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text_end = np.cumsum(np.array([len(x) + 1 for x in raw], np.int64))
    text = np.searchsorted(text_end, begin, "right")
    yield text, None
    size = end - begin
    buf = data[word | (edge == -1)]  # every word and one space behind it
    at = np.cumsum(size + 1) - size - 1
    for run in range(1, min(max_run, len(at)) + 1):
        last = slice(run - 1, len(at))
        whole = np.flatnonzero(text[last] == text[:len(at) - run + 1])
        if len(whole):
            start = at[whole]
            crc = span_crcs(buf, start, at[whole + run - 1] + size[whole + run - 1] - start)
            yield text[whole], (crc % np.uint32(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left out."""

    def task(batches):
        total = np.zeros(buckets, np.int64)
        for batch in text_slices(batches, "t"):
            for _, bucket in features(raw_texts(batch, "t"), buckets, max_run):
                if bucket is not None:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return docs.select(F.col(text).alias("t")).mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str, target_text: str, buckets: int = BUCKETS, max_run: int = MAX_RUN) -> np.ndarray:
    """The gain of every bucket: a table of ``buckets`` numbers, whatever the size of the corpus."""
    def counts(df, column):
        out = np.zeros(buckets, np.int64)
        for bucket, n in bucket_counts(df, column, buckets, max_run).collect():
            out[bucket] = n
        return out

    s, t = counts(docs, text), counts(target, target_text)
    ratio = (t + 1.0) * float(s.sum() + buckets) / ((s + 1.0) * float(t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str, text: str, max_run: int = MAX_RUN) -> DataFrame:
    """(id, n_words, n_features, weight): a row per document."""

    def task(batches):
        value = gain.astype(np.float64)  # sums stay exact below 2^53
        for batch in text_slices(batches, "t"):
            raw = raw_texts(batch, "t")
            words, n, weight = None, np.zeros(len(raw), np.int64), np.zeros(len(raw))
            for where, bucket in features(raw, len(value), max_run):
                if bucket is None:
                    words = np.bincount(where, minlength=len(raw))
                else:
                    n += np.bincount(where, minlength=len(raw))
                    weight += np.bincount(where, weights=value[bucket], minlength=len(raw))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.int64()), pa.array(n), pa.array(weight.astype(np.int64))],
                                             names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).mapInArrow(task, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(doc_id: str, seed: int = SEED) -> Column:
    """floor(1000 g) of the document's Gumbel number g, drawn from sha256(seed:id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` (a table) with each row's position (from 1) in ``order``: range partitions, with the
    number of rows before each from one count per partition."""
    split = materialise(df.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
                        .withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    parts = split.groupBy("__part").agg(F.count("*").alias("rows"), F.min("__at").alias("first")).orderBy("__part").collect()
    shift, before = [], 0
    for part, rows, first in parts:
        shift.append((part, before + 1 - first))
        before += rows
    table = df.sparkSession.createDataFrame(shift, "__part int, __shift long")
    return split.join(F.broadcast(table), "__part").withColumn(out, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = 5, min_words: int = MIN_WORDS, buckets: int = BUCKETS, max_run: int = MAX_RUN, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): a row per document; rank is null for those not drawn.

    ``percent`` of the documents with at least ``min_words`` words are drawn."""
    narrow_batches(docs.sparkSession)
    gain = gains(docs, target, text, target_text, buckets, max_run)
    scored = weigh(docs, gain, doc_id, text, max_run).withColumn("score", F.col("weight") + gumbel("id", seed))
    scored = materialise(scored, "scores")
    fit = F.col("n_words") >= min_words
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    some = ranked(scored.filter(fit), order, "rank")
    drawn = some.count() * percent // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")
    none = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return some.withColumn("rank", rank).unionByName(none).withColumnRenamed("id", doc_id)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights, scores and the draw of 5 % of all documents towards the benchmark's texts."""
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tbl
  FROM range(256) r(i)),
w AS (
  SELECT src, id, row, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT 'd' AS src, doc_id AS id, row_number() OVER () AS row, text FROM documents
        UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark)),
f AS (
  SELECT src, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                      list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM w),
h AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(hex(g)), 2), lambda i: ('0x' || substr(hex(g), i, 2))::BIGINT)),
                            lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM f), crc),
n AS (SELECT src, bucket, count(*) AS n FROM f JOIN h USING (g) GROUP BY ALL),
gain AS (
  SELECT r.bucket, CAST(floor(1000 * ln(CAST((coalesce(b.n, 0) + 1) AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM n WHERE src = 'd') + 10000)
           / (CAST((coalesce(d.n, 0) + 1) AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM n WHERE src = 'b') + 10000)))) AS BIGINT) AS gain
  FROM range(10000) r(bucket) LEFT JOIN n d ON d.bucket = r.bucket AND d.src = 'd' LEFT JOIN n b ON b.bucket = r.bucket AND b.src = 'b'),
v AS (SELECT f.row, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN h USING (g) JOIN gain USING (bucket) WHERE src = 'd' GROUP BY f.row),
s AS (
  SELECT w.id AS doc_id, len(w.w) AS words, coalesce(v.n, 0) AS n_features, coalesce(v.weight, 0) AS weight,
         coalesce(v.weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM w LEFT JOIN v USING (row) WHERE src = 'd'),
r AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place FROM s)
SELECT doc_id, n_features, weight, score,
       CASE WHEN words >= 20 AND place <= (SELECT count(*) FROM s WHERE words >= 20) * 5 // 100 THEN place END AS rank
FROM r
"""
