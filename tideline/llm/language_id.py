"""Language identification by Bayesian evidence fusion.

For every document, over the languages that the corpus declares,

    log P(l | all) = log prior(l | host) + log P(declared | l) + w * log P(text | l) + const

* text: multinomial naive Bayes over hashed byte trigrams of the lower-cased
  text, other ASCII than letters read as spaces.  It is fitted on rows with a
  declared language: all rows of a language that has no more than a bound, about
  that many of any other (chosen by a hash of the text and the row's place).  The
  bound is ``LANGUAGE_ROWS``, or more as far as ``TRAIN_ROWS`` rows in all allow it;
  so the sample has at most about TRAIN_ROWS or languages * LANGUAGE_ROWS rows,
  whichever is more.  Overlapping trigrams are not independent, hence w.
* declared: the markup or metadata language (``<html lang>``, a column, a language
  code in the address).  How far it can be trusted, P(declared | l), is counted
  over the whole corpus.  A missing or unknown declaration is no evidence.
* host: prior(l | host) is smoothed towards its address suffix, that towards the
  whole corpus, each with ``SMOOTH`` pseudo-documents.  The counts are a grouped
  aggregation of the text posteriors over all documents.

A document is kept if the best language reaches ``min_confidence`` and the text
has letters; so null, empty and letterless texts are rejected, as is everything
when no row declares a language.  Ties go to the language first in code order.
Repeated rows are judged alike.  Null hosts and suffixes form a group of their
own.  Extra columns are carried unchanged; the result columns replace columns of
the same name.

Scale: two scans of the texts, no shuffle of them.  What is grouped has a row per
(host, suffix, declaration) and task; the priors (a row per host) are written to
the shared folder, so the planner broadcasts them only while their real size is
below its threshold and otherwise joins by shuffle, where a hot host is split.
The broadcast model has ``BINS`` floats for each of at most ``MAX_LANGUAGES``
languages (26 MB).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tideline.llm.common import materialise, narrow_batches, text_slices, texts
from tideline.sources.tables import read_table

BINS = 1 << 15
TRAIN_ROWS = 20_000
LANGUAGE_ROWS = 1_000
MIN_LANGUAGE_ROWS = 5
MAX_LANGUAGES = 200
SMOOTH = 20.0
TEXT_WEIGHT = 1 / 3
MIN_CONFIDENCE = 0.6

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def trigram_bins(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each trigram, first trigram of each text, trigrams of each text); runs of spaces count once."""
    raw = [f" {t.lower()} ".encode() for t in batch]
    data = _FOLD[np.frombuffer(b"".join(raw), np.uint8)]
    size = np.array([len(r) for r in raw])
    begin = np.r_[0, np.cumsum(size)[:-1]]
    at = np.arange(len(data) - 2)
    ok = ((data[:-2] != 32) | (data[1:-1] != 32)) & ((data[1:-1] != 32) | (data[2:] != 32))
    # no trigram reaches over the end of its text: both ends are spaces, and "space space x" is left out
    h = (data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)
    bins = (h >> np.uint32(17))[ok]
    start = np.searchsorted(at[ok], begin)
    return bins, start, np.diff(np.r_[start, len(bins)])


def log_likelihood(batch: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages log-likelihoods, trigrams of each text)."""
    bins, start, n = trigram_bins(batch)
    out = np.zeros((len(batch), table.shape[1]))
    full = np.flatnonzero(n)
    if len(full):
        out[full] = np.add.reduceat(table[bins], start[full], axis=0)
    return out, n


def posterior(log_p: np.ndarray) -> np.ndarray:
    p = np.exp(log_p - log_p.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def rows_of_each(counts: list[int], train_rows: int) -> int:
    """The bound on a language's rows: what small languages don't use of ``train_rows`` goes to the larger ones."""
    bound, left = 0, train_rows
    for i, n in enumerate(sorted(counts)):
        bound = min(n, left // (len(counts) - i))
        left -= bound
    return max(bound, LANGUAGE_ROWS)


def fit_text_model(docs: DataFrame, text: str, declared: str, train_rows: int = TRAIN_ROWS):
    """(language codes, BINS x languages table of log-probabilities)."""
    counts = docs.filter(F.col(declared).isNotNull()).groupBy(F.col(declared).alias("l")).count()
    top = counts.filter(F.col("count") >= MIN_LANGUAGE_ROWS).orderBy(F.desc("count"), "l").limit(MAX_LANGUAGES).collect()
    langs = sorted(r["l"] for r in top)
    if not langs:
        return [], np.zeros((BINS, 0), np.float32)
    bound = rows_of_each([r["count"] for r in top], train_rows)
    rows = docs.select(F.col(text).alias("t"), F.col(declared).alias("l")).filter(F.col("l").isin(langs))
    if part := {r["l"]: int(bound / r["count"] * (1 << 62)) for r in top if r["count"] > bound}:
        below = F.create_map(*(F.lit(x) for kv in part.items() for x in kv))
        rows = (rows.withColumn("x", F.xxhash64("t", F.monotonically_increasing_id()))
                .filter(F.coalesce(F.pmod("x", F.lit(1 << 62)) < F.element_at(below, F.col("l")), F.lit(True))).drop("x"))
    code = {x: i for i, x in enumerate(langs)}

    def count(batches):
        total = np.zeros((len(langs), BINS), np.int64)
        for batch in text_slices(batches, "t"):
            bins, _, n = trigram_bins(texts(batch, "t"))
            lang = np.array([code[x] for x in batch.column("l").to_pylist()])
            total += np.bincount(np.repeat(lang, n) * BINS + bins, minlength=total.size).reshape(total.shape)
        at, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(b, pa.int32()), pa.array(total[at, b])], names=["l", "b", "n"])

    table = np.full((BINS, len(langs)), 0.5)
    for r in rows.mapInArrow(count, "l int, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).toLocalIterator():
        table[r["b"], r["l"]] += r["n"]
    return langs, np.log(table / table.sum(axis=0)).astype(np.float32)


def identify(docs: DataFrame, text: str = "text", declared: str = "lang", host: str | None = None, suffix: str | None = None,
             carry: list[str] | None = None, min_confidence: float = MIN_CONFIDENCE,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The ``carry`` columns (default: all) and language, confidence, text_language, kept."""
    spark = docs.sparkSession
    narrow_batches(spark)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ("language", "confidence", "text_language", "kept")]
    langs, table = fit_text_model(docs, text, declared, train_rows)
    if not langs:
        return docs.select(*carry, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("kept"))
    model = spark.sparkContext.broadcast(table)
    n_langs, cols = len(langs), [f"p{i}" for i in range(len(langs))]
    keys = [F.col(c).cast("string").alias(k) if c else F.lit(None).cast("string").alias(k)
            for c, k in ((host, "host"), (suffix, "suffix"), (declared, "declared"))]

    def evidence(batches):
        for batch in text_slices(batches, "t"):
            p = posterior(TEXT_WEIGHT * log_likelihood(texts(batch, "t"), model.value)[0])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "suffix", "declared")), *map(pa.array, p.T.copy())],
                                             names=["host", "suffix", "declared", *cols])

    counted = materialise(
        docs.select(F.col(text).alias("t"), *keys)
        .mapInArrow(evidence, "host string, suffix string, declared string, " + ", ".join(f"{c} double" for c in cols))
        .groupBy("host", "suffix", "declared").agg(*(F.sum(c).alias(c) for c in cols)), "language-evidence")

    # trust in declarations: P(declared | l), over the languages known
    trust = np.full((n_langs, n_langs), 0.5) + np.eye(n_langs)
    total = np.zeros(n_langs)
    for r in counted.groupBy("declared").agg(*(F.sum(c).alias(c) for c in cols)).filter(F.col("declared").isNull() | F.col("declared").isin(langs)).collect():
        n = np.array([r[c] for c in cols])
        total += n
        if r["declared"] is not None:
            trust[langs.index(r["declared"])] += n
    log_trust = np.log(trust / trust.sum(axis=0))
    overall = (total + 1) / (total.sum() + n_langs)

    by_host = counted.groupBy("host", "suffix").agg(*(F.sum(c).alias(c) for c in cols))
    by_suffix = counted.groupBy(F.col("suffix").alias("s")).agg(*(F.sum(c).alias(f"s_{c}") for c in cols))
    n_s, n_h = sum((F.col(f"s_{c}") for c in cols), F.lit(0.0)), sum((F.col(c) for c in cols), F.lit(0.0))
    level2 = [(F.col(f"s_{c}") + F.lit(float(SMOOTH * overall[i]))) / (n_s + SMOOTH) for i, c in enumerate(cols)]
    priors = materialise(
        by_host.join(by_suffix, F.col("suffix").eqNullSafe(F.col("s")))
        .select(F.col("host").alias("__host"), F.col("suffix").alias("__suffix"),
                F.array(*(F.log((F.col(c) + SMOOTH * x) / (n_h + SMOOTH)) for c, x in zip(cols, level2))).alias("__prior")),
        "language-priors")

    kinds = {f.name: f for f in docs.schema}
    schema = T.StructType([*(kinds[c] for c in carry), T.StructField("language", T.StringType()), T.StructField("confidence", T.DoubleType()),
                           T.StructField("text_language", T.StringType()), T.StructField("kept", T.BooleanType())])
    left = docs.select(*carry, F.col(text).alias("__text"), keys[2].alias("__declared"), keys[0].alias("__h"), keys[1].alias("__s"))
    joined = left.join(priors, F.col("__h").eqNullSafe(F.col("__host")) & F.col("__s").eqNullSafe(F.col("__suffix")), "left").drop("__h", "__s", "__host", "__suffix")
    code, flat = {x: i for i, x in enumerate(langs)}, np.log(overall)

    def fuse(batches):
        for batch in text_slices(batches, "__text"):
            ll, n = log_likelihood(texts(batch, "__text"), model.value)
            prior = np.array([flat if x is None else x for x in batch.column("__prior").to_pylist()])
            said = np.array([code.get(x, -1) for x in batch.column("__declared").to_pylist()])
            p = posterior(TEXT_WEIGHT * ll + prior + np.where((said >= 0)[:, None], log_trust[said], 0.0))
            best = p.argmax(axis=1)
            names, sure = pa.array(langs), p[np.arange(len(p)), best]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), names.take(pa.array(best)), pa.array(sure),
                 names.take(pa.array(ll.argmax(axis=1), mask=n == 0)), pa.array((sure >= min_confidence) & (n > 0))],
                names=[*carry, "language", "confidence", "text_language", "kept"])

    return joined.mapInArrow(fuse, schema)


def page_evidence(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` with text (tags, scripts and styles taken out), declared, host and suffix columns."""
    body = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", " ")
    declared = F.regexp_extract(F.col(html), r"(?i)<html[^>]*\blang=[\"']?([A-Za-z]{2,3})", 1)
    path = F.regexp_extract(F.col(url), r"^[^:]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    host_of = F.lower(F.regexp_extract(F.col(url), r"^[^:]*://([^/?#]*)", 1))
    said = F.lower(F.when(declared != "", declared).otherwise(path))
    return (pages.withColumn("text", body).withColumn("declared", F.when(said != "", said))
            .withColumn("host", F.when(host_of != "", host_of)).withColumn("suffix", F.regexp_extract(F.col("host"), r"[^.]+\.[^.]+$", 0)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: text, declared ``lang`` and the prior of its ``source``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return identify(docs, "text", "lang", "source", carry=["doc_id", "lang", "source"])


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every web page: text, markup language, address suffix and host."""
    pages = page_evidence(read_table(spark, sf_dir, "pages"))
    return identify(pages, "text", "declared", "host", "suffix", carry=["page_id", "url", "declared"])
