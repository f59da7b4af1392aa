"""Time windows (O-38…O-56, O-59) as grouped aggregates.

All window operators return flat ``window_start`` / ``window_end`` columns
(same type as the time column) so results compare directly with SQL.  Each is
a plain ``groupBy`` so Spark does map-side partial aggregation before the
shuffle; a hot key therefore costs one partial row per map task, not a third
of the data in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us, ntz_from_us
from tideline.operators.sequence import DEFAULT_SLOT, DEFAULT_TARGET_ROWS, join_null_safe, with_split


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def _spark_interval(d: str | int) -> str:
    return f"{duration_us(d)} microseconds"


def _flatten(df: DataFrame, col: str = "window") -> DataFrame:
    return (df.withColumn("window_start", F.col(f"{col}.start"))
              .withColumn("window_end", F.col(f"{col}.end")).drop(col))


def _pane_counts(df: DataFrame, keys: list[str], ts: str, size: str, slide: str, offset: str | None) -> DataFrame:
    """(keys, window_start, window_end, n): rows of each sliding window by ``keys``.

    Rows are first counted per pane, the largest stretch of time that no window
    edge cuts (gcd of size and slide); only these counts are copied to the
    windows that hold the pane.  Rows with a null time are in no window."""
    sz, sl, off = duration_us(size), duration_us(slide), duration_us(offset) if offset else 0
    pane = math.gcd(sz, sl)
    at = F.floor((epoch_us(ts) - F.lit(off)) / F.lit(pane)).cast("bigint") * F.lit(pane)
    panes = df.where(F.col(ts).isNotNull()).groupBy(*keys, at.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    # starts s, multiples of the slide, with s <= pane and pane + its length <= s + size
    first = F.ceil((F.col("_p") + F.lit(pane - sz)) / F.lit(sl)).cast("bigint")
    last = F.floor(F.col("_p") / F.lit(sl)).cast("bigint")
    fan = panes.where(first <= last).withColumn("_s", F.explode(F.sequence(first * F.lit(sl) + F.lit(off), last * F.lit(sl) + F.lit(off), F.lit(sl))))
    return (fan.select(*keys, ntz_from_us("_s").alias("window_start"), ntz_from_us(F.col("_s") + F.lit(sz)).alias("window_end"), F.col("_n").alias("n")))


def window_agg(df: DataFrame, key, ts: str, size: str, slide: str | None = None,
               offset: str | None = None, aggs: list[Column] | None = None) -> DataFrame:
    """Tumbling (slide=None) or sliding event-time window aggregate per key.

    O-38 tumbling, O-39 tumbling with offset, O-40 sliding, O-50 non-keyed
    (key=None), O-56 SQL tumble.  Default aggregate: ``count(*) AS cnt``, for
    sliding windows over panes (see ``_pane_counts``).  Other aggregates are
    Column expressions that can't be merged from panes in general, so with
    them a row is copied to each window that holds it."""
    if aggs is None and slide is not None:
        out = _pane_counts(df, _keys(key), ts, size, slide, offset)
        return out.groupBy(*_keys(key), "window_start", "window_end").agg(F.sum("n").cast("bigint").alias("cnt"))
    aggs = aggs or [F.count(F.lit(1)).alias("cnt")]
    w = F.window(ts, _spark_interval(size), _spark_interval(slide or size),
                 _spark_interval(offset) if offset else "0 seconds")
    return _flatten(df.groupBy(*_keys(key), w.alias("window")).agg(*aggs))


def tumbling_count(df, key, ts, size, offset=None):
    return window_agg(df, key, ts, size, None, offset)


def sliding_count(df, key, ts, size, slide):
    return window_agg(df, key, ts, size, slide)


def pv_per_uv(df: DataFrame, user: str, ts: str, size: str, slide: str) -> DataFrame:
    """O-41: page views / distinct users per sliding window over all rows.
    A user is one row per pane before panes are copied to windows."""
    return (_pane_counts(df, [user], ts, size, slide, None).groupBy("window_start", "window_end")
            .agg(F.sum("n").cast("bigint").alias("pv"), F.countDistinct(user).alias("uv"))
            .withColumn("pv_per_uv", F.round(F.col("pv") / F.col("uv"), 6)))


def distinct_count_window(df: DataFrame, user: str, ts: str, size: str) -> DataFrame:
    """O-42: distinct users per tumbling window (exact)."""
    return window_agg(df, None, ts, size, aggs=[F.countDistinct(user).alias("uv")])


def manual_tumbling_count(df: DataFrame, key, ts: str, size: str) -> DataFrame:
    """O-59: tumbling window assigned by hand, ``floor(ts/size)*size``.

    Must equal ``tumbling_count``; kept as a cross-check of window assignment."""
    s = duration_us(size)
    start_us = F.floor(epoch_us(ts) / F.lit(s)).cast("bigint") * F.lit(s)
    return (df.groupBy(*_keys(key), start_us.alias("_ws")).agg(F.count(F.lit(1)).alias("cnt"))
              .withColumn("window_start", ntz_from_us("_ws"))
              .withColumn("window_end", ntz_from_us(F.col("_ws") + F.lit(s))).drop("_ws"))


#: Relative standard error of a distinct count by sketches of 2^12 registers.
SKETCH_LOG2, SKETCH_ERROR = 12, 1.04 / 64


def distinct_by_sketch(df: DataFrame, user: str, ts: str, size: str, slide: str | None = None, key=None) -> DataFrame:
    """O-41 / O-42 without the users: key(s), window, pv, uv_estimate (relative standard error ``SKETCH_ERROR``).

    One sketch of fixed size per pane (the largest stretch of time that windows share); panes, not
    rows or users, are copied to windows, and a window unites its panes' sketches.  Nulls aren't users."""
    sz, sl = duration_us(size), duration_us(slide or size)
    pane, keys = math.gcd(sz, sl), _keys(key)
    p = F.floor(epoch_us(ts) / F.lit(pane)).cast("bigint") * F.lit(pane)
    panes = df.where(F.col(ts).isNotNull()).groupBy(*keys, p.alias("_p")).agg(F.count(F.lit(1)).alias("_n"), F.hll_sketch_agg(user, SKETCH_LOG2).alias("_h"))
    first = F.ceil((F.col("_p") + F.lit(pane - sz)) / F.lit(sl)).cast("bigint") * F.lit(sl)
    last = F.floor(F.col("_p") / F.lit(sl)).cast("bigint") * F.lit(sl)
    fan = panes.where(first <= last).withColumn("_w", F.explode(F.sequence(first, last, F.lit(sl))))
    out = fan.groupBy(*keys, "_w").agg(F.sum("_n").cast("bigint").alias("pv"), F.hll_sketch_estimate(F.hll_union_agg("_h")).alias("uv_estimate"))
    return (out.withColumn("window_start", ntz_from_us("_w"))
               .withColumn("window_end", ntz_from_us(F.col("_w") + F.lit(sz))).drop("_w"))


def session_windows(df: DataFrame, key, ts: str, gap: str | Column,
                    aggs: list[Column] | None = None, slot: str | int = DEFAULT_SLOT,
                    target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-44 fixed gap (string) / O-45 dynamic gap (Column holding an interval
    string per row).  A row exactly ``gap`` after the previous one joins the
    session (Spark's rule); session_end = max(ts + gap).  Output: key(s),
    session_start, session_end, cnt.

    Spark's own session aggregate sorts every row of a key in one task.  Here
    the buckets of a key (about ``target_rows`` rows each) are sessionized
    apart.  A partial session can only touch another bucket if it starts no
    later than the latest session end of all earlier buckets, or ends no earlier
    than the next bucket's first session starts; those are merged per key (a
    running max of session ends), all others are final.

    ``aggs`` replaces the count by other aggregates.  Those can't be merged
    from partial sessions in general, so this form is Spark's own session
    aggregate, with a key in one task."""
    keys = _keys(key)
    g = _spark_interval(gap) if isinstance(gap, (str, int)) else gap
    if aggs is not None:
        out = df.groupBy(*keys, F.session_window(ts, g).alias("session")).agg(*aggs)
        return (out.withColumn("session_start", F.col("session.start"))
                   .withColumn("session_end", F.col("session.end")).drop("session"))
    d = with_split(df, keys, ts, slot, target_rows)
    part = d.groupBy(*keys, "_last", "_bkt", F.session_window(ts, g).alias("session")).agg(
        F.count(F.lit(1)).alias("cnt"))
    part = part.select(*keys, "_last", "_bkt", F.col("session.start").alias("session_start"),
                       F.col("session.end").alias("session_end"), "cnt")
    span = part.where(F.col("_last") > 0).groupBy(*keys, "_bkt").agg(F.min("session_start").alias("_s"), F.max("session_end").alias("_e"))
    wb = Window.partitionBy(*keys).orderBy("_bkt")
    span = span.select(*keys, "_bkt", F.max("_e").over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_reach"),
                       F.lead("_s").over(wb).alias("_next"))
    part = join_null_safe(part, span, [*keys, "_bkt"], "left")
    touch = F.coalesce(F.col("session_start") <= F.col("_reach"), F.lit(False)) | F.coalesce(F.col("session_end") >= F.col("_next"), F.lit(False))
    part = part.withColumn("_edge", touch)
    final = part.where(~F.col("_edge")).select(*keys, "session_start", "session_end", "cnt")
    edges = part.where(F.col("_edge"))
    wk = Window.partitionBy(*keys).orderBy("session_start", "session_end")
    prev_end = F.max("session_end").over(wk.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.withColumn("_new", F.when(prev_end.isNull() | (F.col("session_start") > prev_end), 1).otherwise(0))
    edges = edges.withColumn("_sid", F.sum("_new").over(wk.rowsBetween(Window.unboundedPreceding, 0)))
    merged = edges.groupBy(*keys, "_sid").agg(F.min("session_start").alias("session_start"),
                                              F.max("session_end").alias("session_end"),
                                              F.sum("cnt").cast("bigint").alias("cnt"))
    return final.unionByName(merged.drop("_sid"))


def cumulative_window(df: DataFrame, key, ts: str, step: str, max_size: str,
                      value: str | None = None) -> DataFrame:
    """O-55 cumulate(step, max): windows [w.start, w.start + (j+1)*step) for
    every step j whose window holds a row.

    Rows are first reduced to (key, max-window, step index) partial counts, and
    only those partials are fanned out to later steps — the fan-out is
    max/step per *group*, not per row."""
    st, mx = duration_us(step), duration_us(max_size)
    if mx % st:
        raise ValueError("max size must be a multiple of step")
    n = mx // st
    keys = _keys(key)
    w_us = F.floor(epoch_us(ts) / F.lit(mx)).cast("bigint") * F.lit(mx)
    i = F.floor((epoch_us(ts) - w_us) / F.lit(st)).cast("bigint")
    part_aggs = [F.count(F.lit(1)).alias("_c")] + ([F.sum(value).alias("_s")] if value else [])
    pre = df.groupBy(*keys, w_us.alias("_w"), i.alias("_i")).agg(*part_aggs)
    fan = pre.withColumn("_j", F.explode(F.sequence(F.col("_i"), F.lit(n - 1).cast("bigint"))))
    fin_aggs = [F.sum("_c").cast("bigint").alias("cnt")] + ([F.sum("_s").alias("total")] if value else [])
    out = fan.groupBy(*keys, "_w", "_j").agg(*fin_aggs)
    return (out.withColumn("window_start", ntz_from_us("_w"))
               .withColumn("window_end", ntz_from_us(F.col("_w") + (F.col("_j") + 1) * F.lit(st)))
               .drop("_w", "_j"))


def early_fire(df: DataFrame, key, ts: str, size: str, step: str) -> DataFrame:
    """O-51: tumbling window that also fires at ``start + i*step``.

    Each firing reports the rows with ``ts <= fire_time`` (empty firings are
    not emitted); the final firing at ``window_end`` reports the whole window.
    Same partial-then-fan-out plan as ``cumulative_window``."""
    sz, st = duration_us(size), duration_us(step)
    if sz % st:
        raise ValueError("size must be a multiple of step")
    n = sz // st
    keys = _keys(key)
    w_us = F.floor(epoch_us(ts) / F.lit(sz)).cast("bigint") * F.lit(sz)
    # first firing index whose time is >= ts: ceil((ts - start) / step)
    i0 = F.ceil((epoch_us(ts) - w_us) / F.lit(st)).cast("bigint")
    pre = df.groupBy(*keys, w_us.alias("_w"), i0.alias("_i")).agg(F.count(F.lit(1)).alias("_c"))
    fan = pre.withColumn("_j", F.explode(F.sequence(F.col("_i"), F.lit(n).cast("bigint"))))
    out = fan.groupBy(*keys, "_w", "_j").agg(F.sum("_c").cast("bigint").alias("cnt"))
    return (out.withColumn("window_start", ntz_from_us("_w"))
               .withColumn("window_end", ntz_from_us(F.col("_w") + F.lit(sz)))
               .withColumn("fire_time", ntz_from_us(F.col("_w") + F.col("_j") * F.lit(st)))
               .drop("_w", "_j"))


def keep_last(df: DataFrame, key, ts: str, size: str, n: int, value: str,
              tiebreak: str | None = None) -> DataFrame:
    """O-52 evictor: keep only the last ``n`` rows of each (key, tumbling
    window) before aggregating.  ``row_number() <= n`` lets Catalyst insert a
    WindowGroupLimit, so at most n rows per group leave each map task."""
    keys = _keys(key)
    sz = duration_us(size)
    w_us = F.floor(epoch_us(ts) / F.lit(sz)).cast("bigint") * F.lit(sz)
    d = df.withColumn("_w", w_us)
    order = [F.col(ts).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    rn = F.row_number().over(Window.partitionBy(*keys, "_w").orderBy(*order))
    kept = d.withColumn("_rn", rn).where(F.col("_rn") <= n)
    out = kept.groupBy(*keys, "_w").agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("total"))
    return (out.withColumn("window_start", ntz_from_us("_w"))
               .withColumn("window_end", ntz_from_us(F.col("_w") + F.lit(sz))).drop("_w"))
