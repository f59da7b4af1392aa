"""A training-corpus pipeline over ``documents``.

``STAGES`` are run in order; each takes (spark, docs, sf_dir) and returns the documents
that stay (all columns of ``documents``), but the last, which returns their ids for training.
Every stage's result is written as Parquet in the cluster's shared folder and read again as the
next one's input, so a lost executor costs at most a part of one stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import decontaminate, language_id, parity_join, pii_sanitise, sentencepiece_codec
from tideline.llm.common import materialise
from tideline.sources.tables import read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; ``lang`` becomes the language found."""
    # under neutral names, so that no column of the documents is taken for one of the operator's
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    found = language_id.identify(docs.toDF(*place.values()), place["text"], place["lang"], place["source"]).filter("kept")
    return found.select(*(found["language" if c == "lang" else at].alias(c) for c, at in place.items()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: Jaccard similarity of five-word shingles of 0.8 or more."""
    return parity_join.keep_one_of_each(docs, threshold=80, k=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced in their texts."""
    return pii_sanitise.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_ids) of every document."""
    return sentencepiece_codec.encode_documents(docs, sentencepiece_codec.public_model(), carry=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", sanitise),
    ("sentencepiece", encode),
]

#: Language scores, connected components over sketches and token ids can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
