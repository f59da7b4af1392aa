"""Joins (O-46, O-47, O-65…O-68).

Range conditions are turned into equi-joins on ``(key, time bucket)`` so a
hot key is spread over many join partitions instead of one; the exact range
predicate is applied after the equi-join.  Strategy (sort-merge, shuffled
hash, broadcast) is left to Catalyst / AQE, which converts a side to a
broadcast only from its measured runtime size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us, ntz_from_us
from tideline.operators.sequence import DEFAULT_SLOT, DEFAULT_TARGET_ROWS, join_null_safe, keyed_neighbours


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else f"{prefix}{c}") for c in df.columns])


def window_join(left: DataFrame, right: DataFrame, key, l_ts: str, r_ts: str, size: str) -> DataFrame:
    """O-65: inner equi-join of rows of the same key in the same tumbling
    window.  Columns of each side are prefixed ``l_`` / ``r_``."""
    keys = _keys(key)
    sz = duration_us(size)
    lw = left.withColumn("_w", F.floor(epoch_us(l_ts) / F.lit(sz)).cast("bigint"))
    rw = right.withColumn("_w", F.floor(epoch_us(r_ts) / F.lit(sz)).cast("bigint"))
    j = _prefixed(lw, "l_", keys + ["_w"]).join(_prefixed(rw, "r_", keys + ["_w"]), on=keys + ["_w"], how="inner")
    return (j.withColumn("window_start", ntz_from_us(F.col("_w") * F.lit(sz)))
             .withColumn("window_end", ntz_from_us((F.col("_w") + 1) * F.lit(sz))).drop("_w"))


def window_cogroup(left: DataFrame, right: DataFrame, key, l_ts: str, r_ts: str, size: str,
                   l_val: str, r_val: str, how: str = "full") -> DataFrame:
    """O-66: per (key, window) the list of left values and of right values —
    also when one side is empty.  ``how`` = inner/left/right/full keeps groups
    with both sides / a left side / a right side / any side.

    Tagged union + one aggregation (no join): each group is one (key, window)."""
    keys = _keys(key)
    sz = duration_us(size)
    lw = left.select(*keys, F.floor(epoch_us(l_ts) / F.lit(sz)).cast("bigint").alias("_w"),
                     F.col(l_val).alias("_lv"), F.lit(None).cast(right.schema[r_val].dataType).alias("_rv"))
    rw = right.select(*keys, F.floor(epoch_us(r_ts) / F.lit(sz)).cast("bigint").alias("_w"),
                      F.lit(None).cast(left.schema[l_val].dataType).alias("_lv"), F.col(r_val).alias("_rv"))
    g = lw.unionByName(rw).groupBy(*keys, "_w").agg(
        F.sort_array(F.collect_list("_lv")).alias("left_values"),
        F.sort_array(F.collect_list("_rv")).alias("right_values"))
    cond = {"inner": (F.size("left_values") > 0) & (F.size("right_values") > 0),
            "left": F.size("left_values") > 0, "right": F.size("right_values") > 0,
            "full": F.lit(True)}[how]
    return (g.where(cond).withColumn("window_start", ntz_from_us(F.col("_w") * F.lit(sz)))
             .withColumn("window_end", ntz_from_us((F.col("_w") + 1) * F.lit(sz))).drop("_w"))


def interval_join(left: DataFrame, right: DataFrame, key, l_ts: str, r_ts: str, lower: str, upper: str) -> DataFrame:
    """O-67: inner join where ``l.ts + lower <= r.ts <= l.ts + upper`` (both
    bounds inclusive).  Right rows sit in buckets of width ``upper - lower``;
    each left row is copied to the (at most two) buckets its range touches,
    the join runs on (key, bucket) and the exact range is checked after."""
    keys = _keys(key)
    lo, hi = duration_us(lower), duration_us(upper)
    width = max(hi - lo, 1)
    lt, rt = epoch_us(l_ts), epoch_us(r_ts)
    lb = left.withColumn("_lus", lt).withColumn(
        "_b", F.explode(F.sequence(F.floor((F.col("_lus") + F.lit(lo)) / F.lit(width)).cast("bigint"),
                                   F.floor((F.col("_lus") + F.lit(hi)) / F.lit(width)).cast("bigint"))))
    rb = right.withColumn("_rus", rt).withColumn("_b", F.floor(F.col("_rus") / F.lit(width)).cast("bigint"))
    lp = _prefixed(lb, "l_", keys + ["_b", "_lus"])
    rp = _prefixed(rb, "r_", keys + ["_b", "_rus"])
    j = lp.join(rp, on=keys + ["_b"], how="inner").where(
        (F.col("_rus") >= F.col("_lus") + F.lit(lo)) & (F.col("_rus") <= F.col("_lus") + F.lit(hi)))
    return j.drop("_b", "_lus", "_rus")


def reconcile(left: DataFrame, right: DataFrame, key, l_id: str, r_id: str, l_ts: str, r_ts: str,
              tolerance: str) -> DataFrame:
    """O-46: match two feeds on key with |Δts| <= tolerance.  Every matching
    pair is reported 'matched'; a left row with no partner is
    'right_missing', a right row with none 'left_missing'.

    One full outer join on (key, time bucket) with the exact range in the join
    condition.  A right row sits in one bucket, and every left row that could
    match it has a copy there, so a right row without partner is exactly
    unmatched.  A left row has a copy in the bucket of each end of its range
    (one or two); it counts as unmatched only if no copy matched, which is
    found by grouping the copies under a row id of the left feed's own.  Ids
    need not be unique; rows with a null time or key match nothing and are
    reported as missing.
    Columns: key(s), l_id, r_id, l_ts, r_ts, status."""
    keys = _keys(key)
    tol = duration_us(tolerance)
    width = max(2 * tol, 1)
    ls = left.select(*keys, F.col(l_id).alias("l_id"), F.col(l_ts).alias("l_ts"), epoch_us(l_ts).alias("_lus"))
    lo, hi = (F.floor((F.col("_lus") + F.lit(x)) / F.lit(width)).cast("bigint") for x in (-tol, tol))
    rs = right.select(*keys, F.col(r_id).alias("r_id"), F.col(r_ts).alias("r_ts"), epoch_us(r_ts).alias("_rus"))
    rs = rs.withColumn("_b", F.floor(F.col("_rus") / F.lit(width)).cast("bigint")).withColumn("_right", F.lit(True))
    # copies of a left row share its content and its number among equal rows, so the id is the same in every run
    same = Window.partitionBy(*keys, "l_id", "l_ts").orderBy(F.lit(0))
    ls = ls.withColumn("_dup", F.row_number().over(same)).withColumn("_left", F.lit(True))
    ls = ls.withColumn("_b", F.explode_outer(F.array_distinct(F.array(lo, hi))))
    la, ra = ls.alias("L"), rs.alias("R")
    cond = [F.col(f"L.{k}") == F.col(f"R.{k}") for k in keys] + [
        F.col("L._b") == F.col("R._b"), F.abs(F.col("R._rus") - F.col("L._lus")) <= F.lit(tol)]
    j = la.join(ra, cond, "full_outer").select(
        *[F.when(F.col("L._left"), F.col(f"L.{k}")).otherwise(F.col(f"R.{k}")).alias(k) for k in keys],
        F.col("L.l_id").alias("l_id"), F.col("R.r_id").alias("r_id"),
        F.col("L.l_ts").alias("l_ts"), F.col("R.r_ts").alias("r_ts"), "_left", "_right", "_dup")
    alone = j.where(F.col("_left") & F.col("_right").isNull())
    paired = j.where(F.col("_left") & F.col("_right"))
    row = [*keys, "l_id", "l_ts", "_dup"]
    alone = join_null_safe(alone.select(*row).distinct(), paired.select(*row).distinct(), row, "left_anti")
    none = {c: F.lit(None).cast(j.schema[c].dataType) for c in ("r_id", "r_ts")}
    out = ["l_id", "r_id", "l_ts", "r_ts"]
    return (paired.select(*keys, *out, F.lit("matched").alias("status"))
            .unionByName(alone.withColumns(none).select(*keys, *out, F.lit("right_missing").alias("status")))
            .unionByName(j.where(F.col("_left").isNull()).select(*keys, *out, F.lit("left_missing").alias("status"))))


def equi_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str]) -> DataFrame:
    """O-47: inner equi-join, left columns first.  Catalyst/AQE pick the
    strategy and split skewed partitions (``skewJoin``)."""
    cond = [left[a] == right[b] for a, b in zip(left_on, right_on)]
    return left.join(right, on=cond, how="inner")


def consecutive_pair_rules(df: DataFrame, key, ts: str, action: str, rules: DataFrame,
                           first: str = "action1", second: str = "action2", tiebreak: str | None = None,
                           slot: str | int = DEFAULT_SLOT, target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-68: rows whose (previous action of the key, this action) equals a
    rule.  The previous action comes from the bucketed neighbour lookup (no
    key-wide window); how the rules table is joined is left to the planner."""
    keys = _keys(key)
    d = keyed_neighbours(df, keys, ts, [action], [-1], tiebreak=tiebreak, slot=slot,
                         target_rows=target_rows)
    prev = f"{action}_prev1"
    r = rules.select(F.col(first).alias("_r1"), F.col(second).alias("_r2"))
    return (d.join(r, (F.col(prev) == F.col("_r1")) & (F.col(action) == F.col("_r2")), "inner")
             .withColumnRenamed(prev, "prev_action").drop("_r1", "_r2"))
