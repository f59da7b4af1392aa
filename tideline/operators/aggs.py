"""Non-windowed keyed aggregates (O-32…O-37, O-48, O-57)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import epoch_ms, ntz_from_ms
from tideline.operators.sequence import DEFAULT_SLOT, DEFAULT_TARGET_ROWS, join_null_safe, keyed_seq, with_split


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def keyed_sum_min_max(df: DataFrame, key, value: str) -> DataFrame:
    """O-32."""
    return df.groupBy(*_keys(key)).agg(F.sum(value).alias("sum_value"), F.min(value).alias("min_value"),
                                       F.max(value).alias("max_value"))


def keyed_min_max_by(df: DataFrame, key, value: str, tiebreak: str, fields: list[str]) -> DataFrame:
    """O-33: whole row with the smallest / largest value per key; ties go to
    the smallest ``tiebreak`` (first arrival)."""
    row = F.struct(*[F.col(c) for c in fields])
    lo = F.min_by(row, F.struct(F.col(value), F.col(tiebreak)))
    hi = F.min_by(row, F.struct(-F.col(value), F.col(tiebreak)))
    out = df.groupBy(*_keys(key)).agg(lo.alias("_lo"), hi.alias("_hi"))
    sel = [*_keys(key)] + [F.col(f"_lo.{c}").alias(f"min_{c}") for c in fields] + \
          [F.col(f"_hi.{c}").alias(f"max_{c}") for c in fields]
    return out.select(*sel)


def running_min_by(df: DataFrame, key, ts: str, value: str, tiebreak: str, fields: list[str],
                   slot: str | int = DEFAULT_SLOT, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-34: after every input row, the row holding the minimum so far of its
    key.  A key is split into buckets of rows; earlier buckets contribute one
    pre-reduced candidate each."""
    keys = _keys(key)
    row = F.struct(F.col(value).alias("_v"), F.col(tiebreak).alias("_t"), *[F.col(c) for c in fields])
    d = with_split(df, keys, ts, slot, target_rows).withColumn("_row", row)
    per_bkt = d.where(F.col("_last") > 0).groupBy(*keys, "_bkt").agg(F.min("_row").alias("_bmin"))
    wk = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    per_bkt = per_bkt.select(*keys, "_bkt", F.min("_bmin").over(wk).alias("_prev"))
    wl = Window.partitionBy(*keys, "_bkt").orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    d = join_null_safe(d.withColumn("_loc", F.min("_row").over(wl)), per_bkt, [*keys, "_bkt"], "left")
    best = F.when(F.col("_prev").isNull() | (F.col("_loc") < F.col("_prev")), F.col("_loc")).otherwise(F.col("_prev"))
    d = d.withColumn("_best", best)
    return d.select(*keys, F.col(tiebreak).alias("at"), *[F.col(f"_best.{c}").alias(f"min_{c}") for c in fields])


def group_count(df: DataFrame, key, col: str) -> DataFrame:
    """O-36 / O-49: unbounded group aggregate (``count(col)``)."""
    return df.groupBy(*_keys(key)).agg(F.count(col).alias("cnt"))


def first_n_average_ms(df: DataFrame, key, ts: str, n: int = 5, tiebreak: str | None = None) -> DataFrame:
    """O-37: integer average of the epoch-ms timestamps of the first ``n`` rows
    of each key, emitted once (keys with fewer rows emit nothing).

    ``row_number() <= n`` becomes a WindowGroupLimit: at most n rows per key
    leave each map task, so a hot key does not flood one reducer."""
    keys = _keys(key)
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.select(*keys, epoch_ms(ts).alias("_ms"), rn.alias("_rn")).where(F.col("_rn") <= n)
    out = (first.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"), F.sum("_ms").alias("_s"))
                .where(F.col("_c") == n))
    avg = F.floor(F.col("_s") / F.lit(n)).cast("bigint")
    return out.select(*keys, avg.alias("avg_ms")).withColumn("avg_ts", ntz_from_ms("avg_ms"))


def every_n_average_ms(df: DataFrame, key, ts: str, n: int = 5, tiebreak: str | None = None,
                       slot: str | int = DEFAULT_SLOT, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-37 with ``repeat``: one average per complete block of n rows."""
    keys = _keys(key)
    d = keyed_seq(df, keys, ts, tiebreak, slot, target_rows=target_rows)
    blk = F.floor((F.col("seq") - 1) / F.lit(n)).cast("bigint")
    out = (d.groupBy(*keys, blk.alias("block")).agg(F.count(F.lit(1)).alias("_c"), F.sum(epoch_ms(ts)).alias("_s"))
            .where(F.col("_c") == n))
    return out.select(*keys, "block", F.floor(F.col("_s") / F.lit(n)).cast("bigint").alias("avg_ms"))


def count_window_tumbling(df: DataFrame, key, ts: str, n: int, value: str, tiebreak: str | None = None,
                          slot: str | int = DEFAULT_SLOT, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-48 countWindow(n): consecutive blocks of n rows per key; only
    complete blocks fire."""
    keys = _keys(key)
    d = keyed_seq(df, keys, ts, tiebreak, slot, target_rows=target_rows)
    blk = F.floor((F.col("seq") - 1) / F.lit(n)).cast("bigint")
    out = (d.groupBy(*keys, blk.alias("block"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum(value).alias("total"))
            .where(F.col("cnt") == n))
    return out


def count_window_sliding(df: DataFrame, key, ts: str, size: int, step: int, value: str,
                         tiebreak: str | None = None, slot: str | int = DEFAULT_SLOT,
                         target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-48 countWindow(size, step): after every ``step``-th row of a key, the
    aggregate of its last ``size`` rows (fewer at the start).

    A bounded frame inside each bucket of rows, over the partitioning that the
    row numbers have already.  Only firing rows among the first ``size - 1`` of a
    later bucket need rows of earlier ones, which are among those buckets' last
    ``size - 1``: these alone are copied to the firing positions they belong to."""
    keys = _keys(key)
    d = keyed_seq(df.select(*dict.fromkeys([*keys, ts, value, *([tiebreak] if tiebreak else [])])), keys, ts, tiebreak, slot,
                  target_rows=target_rows)
    frame = Window.partitionBy(*keys, "_bkt").orderBy(ts, *([tiebreak] if tiebreak else [])).rowsBetween(1 - size, 0)
    head = (F.col("_bkt") > 0) & (F.col("_lrn") < size)
    tail = (F.col("_bkt") < F.col("_last")) & (F.col("_lrn") > F.col("_bcnt") - (size - 1))
    fires = F.col("seq") % step == 0
    inner = (d.withColumn("total", F.sum(value).over(frame)).where(fires & ~head)
              .select(*keys, F.col("seq").alias("fire_seq"), F.least("seq", F.lit(size)).cast("bigint").alias("cnt"), "total"))
    # firing positions f (multiples of step) with seq <= f < seq + size
    first = F.ceil(F.col("seq") / F.lit(step)).cast("bigint") * F.lit(step)
    rim = d.where(head | tail).select(*keys, "seq", F.col(value).alias("_v"), F.explode(
        F.when(first < F.col("seq") + size, F.sequence(first, F.col("seq") + F.lit(size - 1), F.lit(step).cast("bigint")))).alias("fire_seq"), head.alias("_head"))
    rim = rim.groupBy(*keys, "fire_seq").agg(F.count(F.lit(1)).alias("cnt"), F.sum("_v").alias("total"),
                                             F.max(F.col("_head") & (F.col("seq") == F.col("fire_seq"))).alias("_here"))
    return inner.unionByName(rim.where(F.col("_here")).drop("_here"))


def changelog_count(df: DataFrame, key, ts: str, tiebreak: str | None = None,
                    slot: str | int = DEFAULT_SLOT, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-57: changelog of ``count(*) group by key`` in arrival order:
    ``+I`` for a new key, then ``-U`` (old count) and ``+U`` (new count)."""
    keys = _keys(key)
    d = keyed_seq(df, keys, ts, tiebreak, slot, target_rows=target_rows)
    pos = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    ins = F.array(F.struct(F.lit("+I").alias("op"), F.col("seq").alias("cnt"), F.lit(1).alias("o")))
    upd = F.array(F.struct(F.lit("-U").alias("op"), (F.col("seq") - 1).alias("cnt"), F.lit(0).alias("o")),
                  F.struct(F.lit("+U").alias("op"), F.col("seq").alias("cnt"), F.lit(1).alias("o")))
    ch = d.select(*keys, *pos, F.explode(F.when(F.col("seq") == 1, ins).otherwise(upd)).alias("_c"))
    return ch.select(*keys, *[c for c in [ts, tiebreak] if c], F.col("_c.op").alias("op"),
                     F.col("_c.cnt").cast("bigint").alias("cnt"), F.col("_c.o").alias("op_order"))
