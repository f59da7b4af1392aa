"""Sequence patterns (O-78, O-79) as window/bucket plans.

* ``strict_sequence`` — k consecutive rows of a key matching k predicates
  (``next`` contiguity).  Neighbours come from the bucketed lookup in
  ``sequence.keyed_neighbours``; overlapping matches are all reported.
* ``followed_by_within`` — a start row followed (not necessarily directly)
  by an end row of the same key strictly less than ``within`` later:
  matched, else the start times out.  The horizon is bounded, so rows are
  split by (key, bucket of width ``within``) and end rows are also copied to
  the previous bucket; the first end after each start is a running minimum in
  descending time order (linear, no quadratic frame)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us
from tideline.operators.sequence import DEFAULT_SLOT, DEFAULT_TARGET_ROWS, keyed_neighbours


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def strict_sequence(df: DataFrame, key, ts: str, steps: list[Column], carry: list[str],
                    tiebreak: str | None = None, slot: str | int = DEFAULT_SLOT,
                    target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Rows i, i+1, …, i+k-1 of a key satisfy steps[0..k-1].

    Output: key(s) and ``{c}_{j}`` for every carried column c and step j."""
    keys = _keys(key)
    k = len(steps)
    d = df.select(*keys, ts, *[c for c in carry if c != ts], *([tiebreak] if tiebreak and tiebreak not in carry else []),
                  *[s.alias(f"_m{j}") for j, s in enumerate(steps)])
    look = [f"_m{j}" for j in range(1, k)] + list(carry)
    nb = keyed_neighbours(d, keys, ts, look, list(range(1, k)), tiebreak=tiebreak, slot=slot,
                          target_rows=target_rows)
    cond = F.col("_m0")
    for j in range(1, k):
        cond = cond & F.coalesce(F.col(f"_m{j}_next{j}"), F.lit(False))
    hits = nb.where(cond)
    sel = [*keys]
    for j in range(k):
        for c in carry:
            sel.append((F.col(c) if j == 0 else F.col(f"{c}_next{j}")).alias(f"{c}_{j + 1}"))
    return hits.select(*sel)


def followed_by_within(df: DataFrame, key, ts: str, is_start: Column, is_end: Column, within: str,
                       id_col: str) -> DataFrame:
    """Output: key(s), start_id, start_ts, end_id, end_ts (null on timeout),
    status 'matched' | 'timeout'."""
    keys = _keys(key)
    w = duration_us(within)
    d = df.select(*keys, F.col(ts).alias("_ts"), F.col(id_col).alias("_id"),
                  is_start.alias("_s"), is_end.alias("_e"), epoch_us(ts).alias("_us"))
    d = d.where(F.col("_s") | F.col("_e")).withColumn("_b", F.floor(F.col("_us") / F.lit(w)).cast("bigint"))
    starts = d.where(F.col("_s")).select(*keys, "_b", "_ts", "_id", "_us", F.lit(True).alias("_s"),
                                        F.lit(False).alias("_e"))
    ends = d.where(F.col("_e")).select(*keys, "_b", "_ts", "_id", "_us", F.lit(False).alias("_s"),
                                      F.lit(True).alias("_e"))
    ends2 = ends.withColumn("_b", F.explode(F.array(F.col("_b"), F.col("_b") - 1)))
    u = starts.unionByName(ends2)
    # rows after the current one = rows before it in descending order
    wd = Window.partitionBy(*keys, "_b").orderBy(F.col("_us").desc(), F.col("_id").desc(), F.col("_e")) \
               .rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.min(F.when(F.col("_e"), F.struct(F.col("_us"), F.col("_id"), F.col("_ts")))).over(wd)
    s = u.withColumn("_n", nxt).where(F.col("_s"))
    ok = F.col("_n").isNotNull() & (F.col("_n._us") - F.col("_us") < F.lit(w))
    return s.select(*keys, F.col("_id").alias("start_id"), F.col("_ts").alias("start_ts"),
                    F.when(ok, F.col("_n._id")).alias("end_id"), F.when(ok, F.col("_n._ts")).alias("end_ts"),
                    F.when(ok, F.lit("matched")).otherwise(F.lit("timeout")).alias("status"))
