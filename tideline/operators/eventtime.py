"""Event time in batch (O-53, O-54, O-60…O-64).

Batch queries see all rows, so lateness has to be reconstructed from an
explicit arrival order: the watermark a row meets on arrival is
``max(ts of earlier arrivals) - delay`` (bounded out-of-orderness)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us, ntz_from_us
from tideline.operators.ordering import DEFAULT_BLOCK, prefix_max_before


def split_late(df: DataFrame, ts: str, arrival: str, size: str, delay: str,
               block_width: int = DEFAULT_BLOCK, tiebreak: str | None = None) -> DataFrame:
    """O-54: tag each row with its tumbling window and ``is_late``: the window
    had already closed (window_end <= watermark at arrival) when it came."""
    sz, dl = duration_us(size), duration_us(delay)
    d = df.withColumn("_ts_us", epoch_us(ts))
    d = prefix_max_before(d, arrival, "_ts_us", block_width, tiebreak, col="_prev_max")
    w_us = F.floor(F.col("_ts_us") / F.lit(sz)).cast("bigint") * F.lit(sz)
    late = F.coalesce((w_us + F.lit(sz)) <= (F.col("_prev_max") - F.lit(dl)), F.lit(False))
    return (d.withColumn("window_start", ntz_from_us(w_us)).withColumn("window_end", ntz_from_us(w_us + F.lit(sz)))
             .withColumn("is_late", late).drop("_ts_us", "_prev_max"))


def on_time_window_counts(df: DataFrame, key, ts: str, arrival: str, size: str, delay: str,
                          lateness: str = "0 seconds", block_width: int = DEFAULT_BLOCK) -> DataFrame:
    """O-53 / O-54: window counts over rows that were on time, allowing
    ``lateness`` extra (allowed lateness keeps the window updatable)."""
    tagged = split_late(df, ts, arrival, size, f"{duration_us(delay) + duration_us(lateness)} microseconds",
                        block_width)
    keys = [key] if isinstance(key, str) else list(key or [])
    return (tagged.where(~F.col("is_late"))
                  .groupBy(*keys, "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt")))
