"""Repartitioning operators (O-20…O-26).  Each returns the same rows; only
the physical distribution changes, which the caller may rely on for a
following stage (co-located aggregation or join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_by(df: DataFrame, key: str | list[str], n: int | None = None) -> DataFrame:
    """O-20: hash-partition by key (a later groupBy/join on key reuses it)."""
    keys = [key] if isinstance(key, str) else key
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def shuffle(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """O-21: random redistribution."""
    return df.repartition(n, F.rand(seed))


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """O-22: round-robin."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int, up: bool = False) -> DataFrame:
    """O-23: narrow down-scale (coalesce, no shuffle) or up-scale (round-robin);
    Spark has no local-only round-robin, so up-scaling shuffles."""
    return df.repartition(n) if up else df.coalesce(n)


def broadcast_copies(df: DataFrame, n: int, copy_col: str = "copy") -> DataFrame:
    """O-24: every row once per downstream task (n copies, tagged)."""
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def to_single(df: DataFrame) -> DataFrame:
    """O-25: all rows to one task — only for small, bounded results.  An exchange,
    so what is upstream keeps its own parallelism."""
    return df.repartition(1)


def partition_custom(df: DataFrame, n: int, expr: Column) -> DataFrame:
    """O-26: explicit partition id per row (``repartitionById``): row goes to
    partition ``pmod(expr, n)``."""
    return df.repartitionById(n, F.pmod(expr, F.lit(n)).cast("int"))


def with_partition_id(df: DataFrame, col: str = "pid") -> DataFrame:
    return df.withColumn(col, F.spark_partition_id())
