"""Sessions with user-defined aggregates, split over tasks (O-44, O-45 with O-19)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us, ntz_from_us
from tideline.operators.rows import MergeableAggregate, merge_accumulators, partial_accumulators
from tideline.operators.sequence import DEFAULT_SLOT, DEFAULT_TARGET_ROWS, join_null_safe, with_split


def session_aggregate(df: DataFrame, key: str | list[str], ts: str, gap: str | Column, cols: list[str], agg: MergeableAggregate,
                      result: str, out: str = "value", slot: str | int = DEFAULT_SLOT, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``agg`` over the rows of each session: key(s), session_start, session_end, ``out``.

    ``gap``: a duration, or a column of microseconds per row.  A row exactly ``gap`` after the
    previous one joins the session; session_end is the latest ts + gap.  Null keys are a key;
    rows without a time or gap belong to no session.

    A key's rows are cut into buckets of about ``target_rows``; each bucket's rows are dealt to partial
    sessions of their own.  Tasks add rows to one accumulator per partial session.  Partial sessions
    that reach a neighbouring bucket's are joined up by a running maximum of session ends over
    partial sessions, never over rows, and only accumulators are merged.  So neither a hot key nor
    a session of any length meets in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    width = gap if isinstance(gap, Column) else F.lit(duration_us(gap))
    d = df.withColumn("_us", epoch_us(ts)).withColumn("_end", F.col("_us") + width).where(F.col("_us").isNotNull() & F.col("_end").isNotNull())
    d = with_split(d, keys, ts, slot, target_rows).drop("_base")
    in_bucket = Window.partitionBy(*keys, "_bkt").orderBy("_us", "_end")
    before = in_bucket.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_new", F.when(F.col("_us") <= F.max("_end").over(before), 0).otherwise(1))
    d = d.withColumn("_part", F.sum("_new").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))

    part = d.groupBy(*keys, "_last", "_bkt", "_part").agg(F.min("_us").alias("_s"), F.max("_end").alias("_e"))
    by_bucket = Window.partitionBy(*keys).orderBy("_bkt")
    span = part.where(F.col("_last") > 0).groupBy(*keys, "_bkt").agg(F.min("_s").alias("_s0"), F.max("_e").alias("_e0"))
    span = span.select(*keys, "_bkt", F.max("_e0").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)).alias("_reach"), F.lead("_s0").over(by_bucket).alias("_next"))
    part = join_null_safe(part, span, [*keys, "_bkt"], "left")
    touches = F.coalesce(F.col("_s") <= F.col("_reach"), F.lit(False)) | F.coalesce(F.col("_e") >= F.col("_next"), F.lit(False))
    part = part.withColumn("_edge", touches).drop("_reach", "_next", "_last")
    by_key = Window.partitionBy(*keys).orderBy("_s", "_e")
    edges = part.where("_edge")
    earlier = F.max("_e").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.withColumn("_sid", F.sum(F.when(F.col("_s") <= earlier, 0).otherwise(1)).over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*keys, "_sid")
    edges = edges.withColumn("_s", F.min("_s").over(whole)).withColumn("_e", F.max("_e").over(whole)).drop("_sid")
    sessions = part.where("NOT _edge").unionByName(edges).drop("_edge")

    accumulators = partial_accumulators(d, [*keys, "_bkt", "_part"], cols, agg)
    joined = join_null_safe(accumulators, sessions, [*keys, "_bkt", "_part"]).select(*keys, "_s", "_e", "_acc")
    merged = merge_accumulators(joined, [*keys, "_s", "_e"], agg, result, out)
    return merged.select(*keys, ntz_from_us("_s").alias("session_start"), ntz_from_us("_e").alias("session_end"), out)
