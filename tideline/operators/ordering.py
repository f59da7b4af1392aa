"""Global arrival order without an unpartitioned window.

``Window.orderBy(x)`` with no partition puts the whole table in one task.
Here the order column is cut into blocks; per-block summaries (count, max)
are put in order on their own, then each block finishes locally.  A sparse
order column has up to a block per row, so the summaries themselves are
prefixed on three levels (blocks, groups of ``FAN`` blocks, groups of those):
only the top level, a row per ``FAN * FAN`` blocks of the value range, is in one
task.  Used by the buffering sink (O-08, row index) and late-data splitting
(O-54, running max in arrival order).  Rows with a null order value come first,
as in Spark's sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.sequence import join_null_safe

DEFAULT_BLOCK = 100_000
FAN = 2048


def _block(order: str, width: int):
    return F.floor(F.col(order) / F.lit(width)).cast("bigint")


def _with_earlier(blocks: DataFrame, value: str, out: str, total: bool, all_col: str = "_all") -> DataFrame:
    """``out``: sum (``total``) or maximum of ``value`` over all earlier ``_blk`` (null before the first);
    ``all_col``: the same over all blocks."""
    agg = F.sum if total else F.max

    def before(w):
        return agg(value).over(w.rowsBetween(Window.unboundedPreceding, -1))

    b = blocks.withColumn("_g", F.floor(F.col("_blk") / F.lit(FAN)).cast("bigint")).withColumn("_t", F.floor(F.col("_g") / F.lit(FAN)).cast("bigint"))
    top = b.groupBy("_t").agg(agg(value).alias(value))
    top = top.select("_t", before(Window.orderBy("_t")).alias("_p1"), agg(value).over(Window.partitionBy()).alias(all_col))
    group = b.groupBy("_t", "_g").agg(agg(value).alias(value))
    group = group.select("_t", "_g", before(Window.partitionBy("_t").orderBy("_g")).alias("_p2"))
    b = b.withColumn("_p3", before(Window.partitionBy("_t", "_g").orderBy("_blk")))
    b = join_null_safe(join_null_safe(b, group, ["_t", "_g"]), top, ["_t"])
    parts = [F.col(c) for c in ("_p1", "_p2", "_p3")]
    whole = sum((F.coalesce(c, F.lit(0)) for c in parts), F.lit(0)) if total else F.greatest(*parts)
    return b.withColumn(out, whole).drop("_g", "_t", "_p1", "_p2", "_p3")


def global_index(df: DataFrame, order: str, block_width: int = DEFAULT_BLOCK, col: str = "idx",
                 total_col: str | None = None) -> DataFrame:
    """0-based dense position of each row in ``order`` (numeric, unique);
    with ``total_col`` also the total row count (from the block table)."""
    d = df.withColumn("_blk", _block(order, block_width))
    blocks = d.groupBy("_blk").agg(F.count(F.lit(1)).alias("_in_block"))
    cnt = _with_earlier(blocks, "_in_block", "_base", True, total_col or "_all")
    cnt = cnt.select("_blk", *(F.col(c).cast("bigint").alias(c) for c in ["_base", *([total_col] if total_col else [])]))
    lrn = F.row_number().over(Window.partitionBy("_blk").orderBy(order)) - 1
    return (join_null_safe(d.withColumn("_l", lrn), cnt, ["_blk"])
            .withColumn(col, F.col("_base") + F.col("_l")).drop("_blk", "_l", "_base"))


def prefix_max_before(df: DataFrame, order: str, value: str, block_width: int = DEFAULT_BLOCK,
                      tiebreak: str | None = None, col: str = "prev_max") -> DataFrame:
    """max(value) over all rows strictly earlier in (order, tiebreak)."""
    d = df.withColumn("_blk", _block(order, block_width))
    bm = _with_earlier(d.groupBy("_blk").agg(F.max(value).alias("_pfx_m")), "_pfx_m", "_pfx_b", False).select("_blk", "_pfx_b")
    ob = [F.col(order)] + ([F.col(tiebreak)] if tiebreak else [])
    wl = Window.partitionBy("_blk").orderBy(*ob).rowsBetween(Window.unboundedPreceding, -1)
    d = join_null_safe(d.withColumn("_pfx_l", F.max(value).over(wl)), bm, ["_blk"])
    return d.withColumn(col, F.greatest("_pfx_b", "_pfx_l")).drop("_blk", "_pfx_l", "_pfx_b")
