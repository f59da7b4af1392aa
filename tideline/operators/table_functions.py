"""User functions of table shape (O-18): flatMap, partitioned table functions and reduce.

The first two are UDTFs whose ``analyze`` states their result's schema and, for a table argument, how Spark has to
partition and order it; they are called per row, so rows travel in batches of plain values (an Arrow UDTF would build
an Arrow batch for every call's result).  The third merges one value per task and key."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from tideline.operators.rows import MergeableAggregate, user_aggregate


# Widths of the integer types.
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _caster(kind: T.DataType) -> Callable:
    """A function's value as one of ``kind``, or an error: Spark would take a plain value of another type as null, or cut it."""
    if type(kind) in _BITS:
        bound = 1 << (_BITS[type(kind)] - 1)

        def cast(v):
            n = int(v)
            if n != v or not -bound <= n < bound:
                raise ValueError(f"{v!r} is no {kind.simpleString()}")
            return n
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        cast = float
    elif isinstance(kind, T.DecimalType):
        def cast(v):
            return v if isinstance(v, Decimal) else Decimal(str(v))
    elif isinstance(kind, T.StringType):
        cast = str
    elif isinstance(kind, T.BooleanType):
        cast = bool
    elif isinstance(kind, T.ArrayType):
        item = _caster(kind.elementType)

        def cast(v):
            return [item(x) for x in v]
    else:
        return lambda v: v
    return lambda v: None if v is None else cast(v)


def _tuples(schema: T.StructType) -> Callable[[Iterable[tuple]], Iterable[tuple]]:
    casts = [_caster(f.dataType) for f in schema.fields]
    return lambda told: (tuple(c(v) for c, v in zip(casts, t, strict=True)) for t in told)


def flat_map_function(df: DataFrame, fn: Callable[..., Iterable[tuple]], cols: list[str], schema: str, keep: list[str]) -> DataFrame:
    """``keep`` and the columns of ``schema``: a row for each tuple that ``fn(*cols)`` yields for a row; a row for
    which it yields nothing is dropped.  A lateral join with a table function; nothing is shuffled."""
    result = T._parse_datatype_string(schema)
    typed = _tuples(result)

    class FlatMap:
        @staticmethod
        def analyze(*args: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(schema=result)

        def eval(self, *values):
            yield from typed(fn(*values))

    call = F.udtf(FlatMap, useArrow=False)(*[F.col(c).outer() for c in cols])
    return df.select(*dict.fromkeys([*keep, *cols])).lateralJoin(call).select(*keep, *result.names)


def keyed_table_function(df: DataFrame, keys: list[str], order: list[str], cols: list[str], start: Callable[[], object],
                         step: Callable[[object, T.Row], Iterable[tuple]], finish: Callable[[object], Iterable[tuple]],
                         schema: str) -> DataFrame:
    """``keys`` and the columns of ``schema``: a state made by ``start()`` per key takes the key's rows in ``order``;
    ``step(state, row)`` and at the end ``finish(state)`` yield result tuples.  Rows are streamed, not held, but the
    rows of a key are one task's, as an ordered function of all of them needs.  Null keys are a key."""
    result = T._parse_datatype_string(schema)
    out, typed = T.StructType([*(df.schema[k] for k in keys), *result.fields]), _tuples(result)

    class Keyed:
        @staticmethod
        def analyze(table: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(schema=out, partitionBy=[PartitioningColumn(k) for k in keys],
                                 orderBy=[OrderingColumn(c) for c in order])

        def __init__(self):
            self.state, self.key = None, None

        def eval(self, row):
            if self.key is None:
                self.state, self.key = start(), tuple(row[k] for k in keys)
            for t in typed(step(self.state, row)):
                yield (*self.key, *t)

        def terminate(self):
            if self.key is not None:
                for t in typed(finish(self.state)):
                    yield (*self.key, *t)

    rows = df.select(*dict.fromkeys([*keys, *order, *cols]))
    return F.udtf(Keyed, useArrow=False)(rows.asTable())


class Reduced(MergeableAggregate):
    """The rows' tuples of ``cols`` folded by a user's associative and commutative ``fn``."""

    def __init__(self, fn: Callable[[tuple, tuple], tuple], cols: list[str]):
        self.fn, self.cols = fn, cols

    def create(self):
        return None

    def add(self, acc, rows):
        values = zip(*(rows[c].astype(object).where(rows[c].notna(), None) for c in self.cols))
        return functools.reduce(self.merge, values, acc)

    def merge(self, a, b):
        return b if a is None else a if b is None else self.fn(a, b)

    def result(self, acc):
        return None if acc is None else dict(zip(self.cols, acc))


def reduce_function(df: DataFrame, keys: list[str], cols: list[str], fn: Callable[[tuple, tuple], tuple]) -> DataFrame:
    """``keys`` and ``cols``: the key's tuples of ``cols`` folded by ``fn(tuple, tuple) -> tuple``, first within
    each task.  Nulls are passed to ``fn`` as None; null keys are a key."""
    value = ", ".join(f"`{c}`: {df.schema[c].dataType.simpleString()}" for c in cols)
    out = user_aggregate(df, keys, cols, Reduced(fn, cols), f"struct<{value}>", "_reduced")
    return out.select(*keys, *[F.col(f"_reduced.{c}").alias(c) for c in cols])
