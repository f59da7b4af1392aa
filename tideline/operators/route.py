"""Split and merge (O-27…O-31)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_route(df: DataFrame, rules: list[tuple[str, Column]], default: str = "main",
              col: str = "route") -> DataFrame:
    """O-27/O-28: first matching rule names the route (side output tag)."""
    expr = None
    for name, cond in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(col, expr)


def split(df: DataFrame, rules: list[tuple[str, Column]], default: str = "main") -> dict[str, DataFrame]:
    """One DataFrame per route.  Callers writing several routes should persist
    ``add_route`` once (or write partitioned by route) rather than rescan."""
    routed = add_route(df, rules, default)
    names = [n for n, _ in rules] + [default]
    return {n: routed.where(F.col("route") == n).drop("route") for n in names}


def union_all(*dfs: DataFrame) -> DataFrame:
    """O-29: union of same-typed inputs (by name)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def connect(left: DataFrame, right: DataFrame, side_col: str = "side") -> DataFrame:
    """O-30/O-31: two differently typed inputs as one tagged frame (missing
    columns null); a following ``groupBy(key)`` sees both sides together."""
    return (left.withColumn(side_col, F.lit("left"))
                .unionByName(right.withColumn(side_col, F.lit("right")), allowMissingColumns=True))
