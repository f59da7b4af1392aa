"""Per-key ordered sequences without sending a hot key to one task.

Operators that look at neighbouring rows of a key (lead/lag, running
aggregates, row numbers, count windows) would normally use
``Window.partitionBy(key).orderBy(ts)``, which ships *every* row of a key to a
single task.  Here the work unit is ``(key, bucket)``, a stretch of about
``target_rows`` neighbouring rows of a key, and the few values that cross a
bucket edge are carried by small per-bucket summary tables:

* ``keyed_seq`` — dense 1-based position of each row within its key
  (rows of the key in earlier buckets + local row number).
* ``keyed_neighbours`` — lead/lag up to ``k`` rows: inside a bucket by a
  bounded window frame; rows near an inner bucket edge are completed from the
  first/last ``k`` rows of the other buckets (a neighbour at distance <= k is
  always among the first/last k rows of its own bucket).

Buckets are cut by rows: rows are counted per key, the keys above the target
per ``slot`` of time, and neighbouring slots are merged until the target is
reached.  The plan is the same for every input; a key within the target is one
bucket without edges.  Null keys form a key like any other, and null times come
before all others (as Spark sorts them).  The parameters change how work is
split, never the answer; counts are exact, so every branch of a plan sees the
same buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us

DEFAULT_SLOT = "1 minute"
DEFAULT_TARGET_ROWS = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which nulls of the key columns match; the columns come from the left side."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in cols else c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in cols])


def with_split(df: DataFrame, keys: list[str], ts: str, slot: str | int = DEFAULT_SLOT,
               target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``_bkt`` (bucket of about ``target_rows`` rows of the key, from 0 on in
    time order), ``_last`` (the key's last bucket) and ``_base`` (rows of the
    key in earlier buckets)."""
    d = df.withColumn("_slot", F.floor(epoch_us(ts) / F.lit(duration_us(slot))).cast("bigint"))
    big = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kc")).where(F.col("_kc") > F.lit(target_rows)).select(*keys)
    slots = join_null_safe(d.select(*keys, "_slot"), big, keys, "left_semi").groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("_n").over(by_key.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slots = slots.withColumn("_before", before).withColumn("_bkt", F.floor(F.col("_before") / F.lit(target_rows)).cast("bigint"))
    # slots of one size can skip a bucket number; only the order of the numbers matters
    slots = slots.select(*keys, "_slot", "_bkt", F.max("_bkt").over(by_key).alias("_last"),
                         F.min("_before").over(Window.partitionBy(*keys, "_bkt")).alias("_base"))
    zero = F.lit(0).cast("bigint")
    d = join_null_safe(d, slots, [*keys, "_slot"], "left").drop("_slot")
    return d.withColumns({c: F.coalesce(F.col(c), zero) for c in ("_bkt", "_last", "_base")})


def _bucket_window(keys: list[str], order: list[Column]) -> Window:
    return Window.partitionBy(*keys, "_bkt").orderBy(*order)


def keyed_seq(df: DataFrame, key: str | list[str], ts: str, tiebreak: str | None = None,
              slot: str | int = DEFAULT_SLOT, seq_col: str = "seq",
              target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``seq``: 1-based position of each row within its key, ordered by ts
    (then ``tiebreak``).  Also leaves ``_bkt``, ``_last`` (see ``with_split``),
    ``_lrn`` (row number inside the bucket) and ``_bcnt`` (rows in the bucket)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    d = with_split(df, keys, ts, slot, target_rows)
    whole = Window.partitionBy(*keys, "_bkt")
    d = (d.withColumn("_lrn", F.row_number().over(_bucket_window(keys, order)).cast("bigint"))
          .withColumn("_bcnt", F.count(F.lit(1)).over(whole)))
    return d.withColumn(seq_col, F.col("_base") + F.col("_lrn")).drop("_base")


def keyed_neighbours(df: DataFrame, key: str | list[str], ts: str, cols: list[str],
                     offsets: list[int], tiebreak: str | None = None,
                     slot: str | int = DEFAULT_SLOT,
                     target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """For each offset j (positive = lead, negative = lag) and column c add
    ``{c}_{'next' if j>0 else 'prev'}{|j|}`` holding c of the row j positions
    away within the key (null past either end)."""
    keys = [key] if isinstance(key, str) else list(key)
    k_max = max(abs(j) for j in offsets)
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    d = keyed_seq(df, keys, ts, tiebreak, slot, target_rows=target_rows)
    wl = _bucket_window(keys, order)

    def name(c, j):
        return f"{c}_{'next' if j > 0 else 'prev'}{abs(j)}"

    for j in offsets:
        for c in cols:
            d = d.withColumn(name(c, j), F.lead(c, j).over(wl) if j > 0 else F.lag(c, -j).over(wl))

    # only rows within k_max of an inner bucket edge can have a neighbour in another bucket
    edge = (((F.col("_lrn") <= k_max) & (F.col("_bkt") > 0))
            | ((F.col("_lrn") > F.col("_bcnt") - k_max) & (F.col("_bkt") < F.col("_last"))))
    d = d.withColumn("_edge", edge)
    inner = d.where(~F.col("_edge"))
    rim = d.where(F.col("_edge"))
    # all neighbours of a rim row in one joined row: an array over the offsets
    wanted = rim.select(*keys, "seq", F.explode(F.array(*[F.lit(j) for j in offsets])).alias("_j"))
    found = rim.select(*keys, F.col("seq").alias("_nseq"), F.struct(*[F.col(c).alias(f"_n_{c}") for c in cols]).alias("_v"))
    found = join_null_safe(wanted.withColumn("_nseq", F.col("seq") + F.col("_j")), found, [*keys, "_nseq"])
    found = found.groupBy(*keys, "seq").agg(*[F.max(F.when(F.col("_j") == j, F.col("_v"))).alias(f"_v{i}") for i, j in enumerate(offsets)])
    fixed = join_null_safe(rim, found, [*keys, "seq"], "left")
    for i, j in enumerate(offsets):
        for c in cols:
            # inside the bucket the window value is right; the lookup fills the edge
            near = (F.col("_lrn") + j >= 1) & (F.col("_lrn") + j <= F.col("_bcnt"))
            fixed = fixed.withColumn(name(c, j), F.when(near, F.col(name(c, j))).otherwise(F.col(f"_v{i}._n_{c}")))
    return inner.unionByName(fixed.select(*inner.columns)).drop("_edge", "_bkt", "_last", "_lrn", "_bcnt")


def running_aggregates(df: DataFrame, key: str | list[str], ts: str, value: str,
                       tiebreak: str | None = None, slot: str | int = DEFAULT_SLOT,
                       target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Running count / sum / min / max of ``value`` per key in ts order (O-34, O-35).

    Prefix values of earlier buckets come from a per-bucket summary table, so
    no task sees more than one (key, bucket).  Null values are skipped; sum, min
    and max are null until a value came."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    d = with_split(df, keys, ts, slot, target_rows)
    summ = d.where(F.col("_last") > 0).groupBy(*keys, "_bkt").agg(
        F.sum(value).alias("_s"), F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    wk = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*keys, "_bkt", F.sum("_s").over(wk).alias("_ps"),
                       F.min("_mn").over(wk).alias("_pmn"), F.max("_mx").over(wk).alias("_pmx"))
    wl = _bucket_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    d = (d.withColumn("_lc", F.count(F.lit(1)).over(wl))
          .withColumn("_ls", F.sum(value).over(wl))
          .withColumn("_lmn", F.min(value).over(wl))
          .withColumn("_lmx", F.max(value).over(wl)))
    d = join_null_safe(d, summ, [*keys, "_bkt"], "left")
    both = F.coalesce(F.col("_ps") + F.col("_ls"), F.col("_ps"), F.col("_ls"))
    return (d.withColumn("running_count", (F.col("_base") + F.col("_lc")).cast("bigint"))
             .withColumn("running_sum", both)
             .withColumn("running_min", F.least("_pmn", "_lmn"))
             .withColumn("running_max", F.greatest("_pmx", "_lmx"))
             .drop("_bkt", "_last", "_base", "_lc", "_ls", "_lmn", "_lmx", "_ps", "_pmn", "_pmx"))
