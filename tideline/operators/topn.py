"""Ranking and top-N (O-69…O-72)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], score: str, n: int, tiebreak: list[str],
                    rank_col: str = "rn") -> DataFrame:
    """O-69: ``row_number() over (partition by group order by score desc, tiebreak) <= n``.

    Catalyst turns the filter into a WindowGroupLimit, which keeps only n rows
    per group on the map side before the shuffle."""
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), *[F.col(t) for t in tiebreak])
    return (df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
              .where(F.col(rank_col) <= n))


def top_n_by_aggregate(df: DataFrame, group: list[str], item: str, score: str, n: int,
                       bounded: bool = True) -> DataFrame:
    """O-70/O-71 second stage: regroup (item, score) rows by ``group`` and keep
    the n best ``(score desc, item asc)`` with their rank.

    ``bounded=True`` (batch): a ``row_number`` filter that Catalyst runs as a
    WindowGroupLimit — n rows per group per task, whatever the group size.
    ``bounded=False``: an aggregate (``slice(sort_array(collect_list))``), the
    only form append-mode streams accept; a group then holds one entry per
    distinct item."""
    if bounded:
        return top_n_per_group(df, group, score, n, [item]).select(*group, item, score, "rn")
    packed = F.struct((-F.col(score)).alias("neg"), F.col(item).alias("item"), F.col(score).alias("score"))
    agg = df.groupBy(*group).agg(F.slice(F.sort_array(F.collect_list(packed)), 1, n).alias("_top"))
    ex = agg.select(*group, F.posexplode("_top").alias("_pos", "_e"))
    return ex.select(*group, F.col("_e.item").alias(item), F.col("_e.score").alias(score),
                     (F.col("_pos") + 1).cast("bigint").alias("rn"))


def sort_by_count(df: DataFrame, score: str, tiebreak: list[str]) -> DataFrame:
    """O-72: global order by score desc (range-partitioned sort, no single task)."""
    return df.orderBy(F.col(score).desc(), *[F.col(t) for t in tiebreak])
