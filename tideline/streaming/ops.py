"""Streaming operators with watermarks (O-29, O-38…O-56, O-60…O-67).

Input time columns may be TIMESTAMP_NTZ (the test tables); a watermark needs
TIMESTAMP, so ``with_event_time`` converts zone-independently and outputs are
converted back to NTZ so stream results equal the batch operators'.
Windows close when ``watermark >= window_end`` (Spark); at end of a bounded
run only windows with ``end <= max(ts) - delay`` have been emitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, event_time, to_ntz
from tideline.operators.windows import SKETCH_LOG2


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def _iv(d) -> str:
    return f"{duration_us(d)} microseconds"


def with_event_time(df: DataFrame, ts: str, delay: str = "0 seconds", out: str = "et") -> DataFrame:
    """O-60…O-64: event-time column + bounded-out-of-orderness watermark
    (delay 0 = monotone timestamps)."""
    return df.withColumn(out, event_time(ts)).withWatermark(out, _iv(delay))


def _flat(df: DataFrame, col: str = "window") -> DataFrame:
    return (df.withColumn("window_start", to_ntz(F.col(f"{col}.start")))
              .withColumn("window_end", to_ntz(F.col(f"{col}.end"))).drop(col))


def window_count(df: DataFrame, key, ts: str, size: str, slide: str | None = None, delay: str = "0 seconds",
                 offset: str | None = None, aggs: list[Column] | None = None) -> DataFrame:
    """Tumbling / sliding window aggregate in append mode."""
    d = with_event_time(df, ts, delay)
    w = F.window("et", _iv(size), _iv(slide or size), _iv(offset) if offset else "0 seconds")
    aggs = aggs or [F.count(F.lit(1)).alias("cnt")]
    return _flat(d.groupBy(*_keys(key), w.alias("window")).agg(*aggs))


def distinct_count(df: DataFrame, user: str, ts: str, size: str, slide: str | None = None,
                   delay: str = "0 seconds") -> DataFrame:
    """O-41/O-42 on a stream: exact distinct count in two chained aggregations,
    (window, user) then window, so a window's users are rows of the state store,
    not a set in one row (``count(distinct)`` is rejected on streams)."""
    d = with_event_time(df, ts, delay)
    w = F.window("et", _iv(size), _iv(slide or size))
    users = d.groupBy(w.alias("window"), user).agg(F.count(F.lit(1)).alias("_n"))
    out = _flat(users.groupBy("window").agg(F.sum("_n").cast("bigint").alias("pv"), F.count(user).alias("uv")))
    return out.withColumn("pv_per_uv", F.round(F.col("pv") / F.col("uv"), 6))


def distinct_by_sketch(df: DataFrame, user: str, ts: str, size: str, slide: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """O-41 / O-42 on a stream without the users: a window's state is one sketch of fixed size
    (relative standard error ``windows.SKETCH_ERROR``)."""
    d = with_event_time(df, ts, delay)
    w = F.window("et", _iv(size), _iv(slide or size)).alias("window")
    return _flat(d.groupBy(w).agg(F.count(F.lit(1)).alias("pv"), F.hll_sketch_estimate(F.hll_sketch_agg(user, SKETCH_LOG2)).alias("uv_estimate")))


def session_count(df: DataFrame, key, ts: str, gap: str | Column, delay: str = "0 seconds") -> DataFrame:
    d = with_event_time(df, ts, delay)
    g = _iv(gap) if isinstance(gap, (str, int)) else gap
    out = d.groupBy(*_keys(key), F.session_window("et", g).alias("session")).agg(F.count(F.lit(1)).alias("cnt"))
    return (out.withColumn("session_start", to_ntz(F.col("session.start")))
               .withColumn("session_end", to_ntz(F.col("session.end"))).drop("session"))


def _step_counts(df: DataFrame, key, ts: str, size: str, index: Column, last: int, delay: str) -> DataFrame:
    """keys, w, _j, cnt: rows of the window whose step index is at most ``_j``.  Rows are counted per
    step; only these counts fan out to later steps, in a second aggregation.  The window stays
    a grouping key of both, so that the watermark closes a group with its window."""
    d = with_event_time(df, ts, delay).withColumn("w", F.window("et", _iv(size)))
    steps = d.groupBy(*_keys(key), "w", index.cast("bigint").alias("_i")).agg(F.count(F.lit(1)).alias("_n"))
    fan = steps.withColumn("_j", F.explode(F.sequence("_i", F.lit(last).cast("bigint"))))
    return fan.groupBy(*_keys(key), "w", "_j").agg(F.sum("_n").cast("bigint").alias("cnt"))


def cumulative_count(df: DataFrame, key, ts: str, step: str, max_size: str, delay: str = "0 seconds") -> DataFrame:
    """O-55 on a stream: the counts of a window up to each of its steps."""
    st, mx = duration_us(step), duration_us(max_size)
    i = F.floor((F.unix_micros("et") - F.unix_micros(F.col("w.start"))) / F.lit(st))
    out = _step_counts(df, key, ts, max_size, i, mx // st - 1, delay)
    end = F.timestamp_micros(F.unix_micros(F.col("w.start")) + (F.col("_j") + 1) * F.lit(st))
    return out.withColumn("window_start", to_ntz(F.col("w.start"))).withColumn("window_end", to_ntz(end)).drop("w", "_j")


def interval_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, lower: str, upper: str,
                  delay: str = "0 seconds", how: str = "inner") -> DataFrame:
    """O-67 stream-stream: both sides watermarked so join state is dropped
    once no future row can match.  Columns prefixed l_ / r_."""
    lo, hi = duration_us(lower), duration_us(upper)
    l2 = with_event_time(left, l_ts, delay, "l_et").select(*[F.col(c).alias(f"l_{c}") for c in left.columns], "l_et")
    r2 = with_event_time(right, r_ts, delay, "r_et").select(*[F.col(c).alias(f"r_{c}") for c in right.columns], "r_et")
    cond = (F.col(f"l_{key}") == F.col(f"r_{key}")) & \
           (F.col("r_et") >= F.col("l_et") + F.expr(f"INTERVAL {lo} MICROSECONDS")) & \
           (F.col("r_et") <= F.col("l_et") + F.expr(f"INTERVAL {hi} MICROSECONDS"))
    return l2.join(r2, cond, how).drop("l_et", "r_et")


def window_join(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, size: str,
                delay: str = "0 seconds") -> DataFrame:
    """O-65 stream-stream: equi-join on (key, window)."""
    l2 = with_event_time(left, l_ts, delay, "l_et")
    l2 = l2.select(*[F.col(c).alias(f"l_{c}") for c in left.columns], F.window("l_et", _iv(size)).alias("l_w"))
    r2 = with_event_time(right, r_ts, delay, "r_et")
    r2 = r2.select(*[F.col(c).alias(f"r_{c}") for c in right.columns], F.window("r_et", _iv(size)).alias("r_w"))
    j = l2.join(r2, (F.col(f"l_{key}") == F.col(f"r_{key}")) & (F.col("l_w") == F.col("r_w")), "inner")
    return (j.withColumn("window_start", to_ntz(F.col("l_w.start"))).withColumn("window_end", to_ntz(F.col("l_w.end")))
             .drop("l_w", "r_w"))


def window_cogroup(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, size: str,
                   l_val: str, r_val: str, delay: str = "0 seconds") -> DataFrame:
    """O-66 on streams: tagged union, one windowed aggregation (append)."""
    lw = left.select(F.col(key).alias("k"), F.col(l_ts).alias("t"), F.col(l_val).alias("lv"),
                     F.lit(None).cast(right.schema[r_val].dataType).alias("rv"))
    rw = right.select(F.col(key).alias("k"), F.col(r_ts).alias("t"),
                      F.lit(None).cast(left.schema[l_val].dataType).alias("lv"), F.col(r_val).alias("rv"))
    u = with_event_time(lw.unionByName(rw), "t", delay)
    g = u.groupBy("k", F.window("et", _iv(size)).alias("window")).agg(
        F.sort_array(F.collect_list("lv")).alias("left_values"), F.sort_array(F.collect_list("rv")).alias("right_values"))
    return _flat(g).withColumnRenamed("k", key)


def union_watermarked(*dfs: DataFrame) -> DataFrame:
    """O-29: union of streams; with the default ``multipleWatermarkPolicy=min``
    the combined watermark follows the slowest input."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def processing_time_window_count(df: DataFrame, key, size: str) -> DataFrame:
    """O-43: processing-time tumbling window — rows are stamped with the
    micro-batch time, then windowed (rows-only checkable)."""
    d = df.withColumn("pt", F.current_timestamp())
    return _flat(d.groupBy(*_keys(key), F.window("pt", _iv(size)).alias("window")).agg(F.count(F.lit(1)).alias("cnt")))


def reconcile(left: DataFrame, right: DataFrame, key: str, l_ts: str, r_ts: str, tolerance: str,
              delay: str = "0 seconds") -> DataFrame:
    """O-46 on streams: full outer stream-stream join on key with
    |Δt| <= tolerance.  Matches come out as they happen; a row with no
    partner comes out (other side null) once the watermark passes
    ts + tolerance.  Adds ``status``."""
    j = interval_join(left, right, key, l_ts, r_ts, f"-{duration_us(tolerance)} microseconds",
                      f"{duration_us(tolerance)} microseconds", delay, how="full_outer")
    st = (F.when(F.col(f"l_{key}").isNull(), F.lit("left_missing"))
           .when(F.col(f"r_{key}").isNull(), F.lit("right_missing")).otherwise(F.lit("matched")))
    return j.withColumn("status", st)


def equi_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """O-47 on streams: inner stream-stream equi-join.  Without watermarks its
    state grows without bound; give both inputs a watermark and a time
    condition (``interval_join``) for long-running jobs."""
    return left.join(right, left[left_on] == right[right_on], "inner")


def window_count_with_lateness(df: DataFrame, key, ts: str, size: str, delay: str, lateness: str) -> DataFrame:
    """O-53: windows stay updatable for ``lateness`` beyond the disorder
    bound; run in ``update`` output mode — the last row per window is final."""
    total = f"{duration_us(delay) + duration_us(lateness)} microseconds"
    return window_count(df, key, ts, size, None, total)


def running_aggregate(df: DataFrame, key, aggs: list[Column]) -> DataFrame:
    """O-32…O-36 on a stream: keyed aggregate in ``update`` output mode — each
    micro-batch emits the changed keys with their values so far (per batch,
    not per row)."""
    return df.groupBy(*_keys(key)).agg(*aggs)


def early_fire_count(df: DataFrame, key, ts: str, size: str, step: str, delay: str = "0 seconds") -> DataFrame:
    """O-51 on a stream: snapshots at ``start + i*step`` (rows with ts <= T) plus the full window at its end."""
    sz, st = duration_us(size), duration_us(step)
    i0 = F.ceil((F.unix_micros("et") - F.unix_micros(F.col("w.start"))) / F.lit(st))
    out = _step_counts(df, key, ts, size, i0, sz // st, delay)
    fire = F.timestamp_micros(F.unix_micros(F.col("w.start")) + F.col("_j") * F.lit(st))
    return (out.withColumn("window_start", to_ntz(F.col("w.start"))).withColumn("window_end", to_ntz(F.col("w.end")))
               .withColumn("fire_time", to_ntz(fire)).drop("w", "_j"))
