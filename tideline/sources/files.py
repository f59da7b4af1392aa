"""Text / CSV sources (O-02) with explicit schemas — no inference, so a
stream and a batch read of the same folder see the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The click-event CSV layout (user, url, epoch ms).
CLICK_CSV_SCHEMA = "users string, urls string, ms long"


def read_lines(spark: SparkSession, path: str, stream: bool = False, files_per_trigger: int = 1) -> DataFrame:
    """Text files -> one ``value`` row per line."""
    if stream:
        return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: str = CLICK_CSV_SCHEMA, stream: bool = False,
             header: bool = False, files_per_trigger: int = 1) -> DataFrame:
    """CSV with a given schema; malformed rows become nulls (PERMISSIVE)."""
    r = spark.readStream.option("maxFilesPerTrigger", files_per_trigger) if stream else spark.read
    return r.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
