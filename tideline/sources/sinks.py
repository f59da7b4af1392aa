"""Batch form of the buffering sink (O-08); streaming sinks are in
``tideline.streaming.sinks``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.ordering import DEFAULT_BLOCK, global_index


def assign_batches(df: DataFrame, order: str, n: int, block_width: int = DEFAULT_BLOCK,
                   hold_back_partial: bool = True) -> DataFrame:
    """O-08 batch form: ``batch_no = index div n`` in ``order``; the trailing
    incomplete batch stays buffered (not emitted) unless told otherwise."""
    d = global_index(df, order, block_width, col="_idx", total_col="_n")
    d = d.withColumn("batch_no", F.floor(F.col("_idx") / F.lit(n)).cast("bigint"))
    if hold_back_partial:
        d = d.where(F.col("_idx") < F.floor(F.col("_n") / F.lit(n)) * F.lit(n))
    return d.drop("_idx", "_n")
