"""Quality classifier: ridge regression on random Fourier features, calibrated.

``FEATURES`` statistics of a text (sizes, shares of character classes, repetition of words and
lines; never language, source or id) are standardised and mapped to ``DIM`` random Fourier
features sqrt(2/DIM) cos(w x + b), w normal, whose inner product approximates the Gaussian
kernel exp(-|x - y|^2 / 2 s^2).  Every task sums the normal equations of its rows; the sums are
added by Spark and solved on the driver (DIM x DIM numbers, whatever the input).  Ridge scores of a
fold that the fit didn't see are made probabilities by isotonic regression over ``BUCKETS`` score
buckets.

Folds are crc32(id as text) mod 5: 0 is held out and its labels are never read, 1 calibrates, 2 to
4 fit.  At most about ``TRAIN_ROWS`` labelled rows are used (chosen by a hash of the id; all when
there are fewer).  Equal probabilities are told apart by a thousandth of the ridge score.

Scale: texts are read once; the statistics (a row of ``FEATURES`` floats per document) are written
to the shared folder, joined with the labels and scored from there.

Edge cases: null and empty texts have zero statistics and get a score; repeated rows are scored
alike; several labels of an id count as their mean; without labels every score is 0.5, with labels
of one class it is that class; an empty table gives none.  A null id is in no fold that learns and
isn't held out.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.llm.common import Shared, materialise, raw_texts, text_slices
from tideline.sources.tables import read_table

TRAIN_ROWS = 100_000
DIM = 256
RIDGE = 1e-3
BUCKETS = 4096
SEED = 17
THRESHOLD = 0.3
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"#*$%&|<>", b".,;:", b"!?", bytes(range(128, 256))]
FEATURES = 7 + len(_CLASSES) + 9


def statistics(raw: bytes) -> list[float]:
    n = len(raw)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    if not words:
        return [0.0] * FEATURES
    k, counts = len(words), Counter(words)
    distinct, top = len(counts), max(counts.values())
    starts = len(set(zip(words, words[1:], words[2:])))
    size = sum(map(len, words))
    return [
        math.log1p(n), math.log1p(k), size / k, math.log1p(max(map(len, words))), distinct / k, top / k, math.log(distinct + 1) / math.log(k + 1),
        *((n - len(raw.translate(None, c))) / n for c in _CLASSES),
        sum(map(eq, words, words[1:])) / k, starts / max(1, k - 2), sum(map(bytes.isupper, words)) / k, sum(map(bytes.isalpha, words)) / k,
        math.log1p(len(lines)), k / len(lines) / 100, len(set(lines)) / len(lines), counts.get(b"|", 0) / k, math.sqrt(sum(c * c for c in counts.values())) / k,
    ]


def features(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, fold, x): fold is crc32(id) mod 5."""

    def task(batches):
        for batch in text_slices(batches, "t"):
            x = np.array([statistics(t) for t in raw_texts(batch, "t")], np.float32)
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fold"), x], names=["id", "fold", "x"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)).cast("int").alias("fold"),
                       F.col(text).alias("t")).mapInArrow(task, f"id {kind}, fold int, x array<float>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64)


class Model:
    """mean, scale: of the statistics; beta: ridge solution; xs, ys: calibration curve."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.standard_normal((FEATURES, DIM)) / math.sqrt(FEATURES)
        self.b = rng.uniform(0, 2 * math.pi, DIM)
        self.beta, self.xs, self.ys = np.zeros(DIM + 1), np.array([0.0]), np.array([0.5])

    def map(self, x: np.ndarray) -> np.ndarray:
        z = math.sqrt(2 / DIM) * np.cos(np.clip((x - self.mean) / self.scale, -6, 6) @ self.w + self.b)
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.map(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        r = self.raw(x)
        return np.clip(0.999 * np.interp(r, self.xs, self.ys) + 0.001 * np.clip(r, 0, 1), 0, 1)


def isotonic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and increasing means.  x ascending, y sums over n rows."""
    blocks: list[list[float]] = []
    for a, c, s in zip(x, n, y):
        blocks.append([a * c, c, s])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit(table: DataFrame, labels: DataFrame, doc_id: str, label: str, train_rows: int = TRAIN_ROWS) -> Model:
    """table: of features()."""
    spark = table.sparkSession
    y = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.avg(label).alias("y"))
    rows = table.filter(F.col("fold") > 0).join(y, "id").select("id", "fold", "x", "y")
    n = rows.count()
    if n > train_rows:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * train_rows / n))
    rows = materialise(rows.coalesce(16), "train")
    moments = rows.select(F.col("y"), *(F.get("x", F.lit(i)).cast("double").alias(f"x{i}") for i in range(FEATURES))).agg(
        F.count("*").alias("n"), F.avg("y").alias("y"), *(f(f"x{i}").alias(f"{k}{i}") for i in range(FEATURES) for f, k in ((F.avg, "m"), (F.stddev_pop, "s")))).first()
    model = Model(np.array([moments[f"m{i}"] or 0.0 for i in range(FEATURES)]), np.array([max(1e-6, moments[f"s{i}"] or 0.0) for i in range(FEATURES)]))
    if not moments["n"] or moments["y"] in (0.0, 1.0):
        model.ys = np.array([0.5 if not moments["n"] else moments["y"]])
        return model
    shared = Shared(spark, model)
    iu = np.triu_indices(DIM + 1)

    def normal(batches):
        a, b, n = np.zeros((DIM + 1, DIM + 1)), np.zeros(DIM + 1), 0
        for batch in batches:
            z, y = shared.value.map(_matrix(batch)), batch.column("y").to_numpy()
            a, b, n = a + z.T @ z, b + z.T @ y, n + len(y)
        if n:
            i = np.r_[iu[0], np.arange(DIM + 1)]
            j = np.r_[iu[1], np.full(DIM + 1, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.r_[a[iu], b])], names=["i", "j", "v"])

    a, b = np.zeros((DIM + 1, DIM + 1)), np.zeros(DIM + 1)
    fit_rows = rows.filter("fold > 1")
    for r in fit_rows.mapInArrow(normal, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["j"] < 0:
            b[r["i"]] = r["v"]
        else:
            a[r["i"], r["j"]] = a[r["j"], r["i"]] = r["v"]
    model.beta = np.linalg.solve(a + RIDGE * max(1.0, a[DIM, DIM]) * np.diag(np.r_[np.ones(DIM), 0]) + 1e-9 * np.eye(DIM + 1), b)
    fitted = Shared(spark, model)

    def bucket(batches):
        for batch in batches:
            r = fitted.value.raw(_matrix(batch))
            at = np.floor(np.clip((r + 1) / 3, 0, 1 - 1e-9) * BUCKETS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(r), batch.column("y")], names=["at", "r", "y"])

    seen = (rows.filter("fold = 1").mapInArrow(bucket, "at int, r double, y double").groupBy("at")
            .agg(F.avg("r").alias("r"), F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("at").collect())
    if seen:
        model.xs, model.ys = isotonic(*(np.array([float(r[c]) for r in seen]) for c in ("r", "n", "y")))
    else:
        model.xs, model.ys = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                    train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted): a row per document."""
    table = materialise(features(docs, doc_id, text), "features")
    shared = Shared(docs.sparkSession, fit(table, labels, doc_id, label, train_rows))

    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fold"), pa.array(shared.value.score(_matrix(batch)))], names=["id", "fold", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    out = table.mapInArrow(task, f"id {kind}, fold int, score double")
    return out.select(F.col("id").alias(doc_id), F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
