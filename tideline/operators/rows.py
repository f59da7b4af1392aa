"""Row-level operators (O-09…O-19): projection, filters, 1→n emitters, the
"rich" per-task set-up/tear-down map, and user-defined aggregates.

Everything is a Column expression except ``rich_map`` (Arrow-batched
``mapInPandas``) and ``user_aggregate`` (accumulators per task, merged after the
shuffle), which exist because users bring functions of those shapes."""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """O-10 / O-16 map to fields."""
    return df.select(*cols)


def key_one(df: DataFrame, key: str) -> DataFrame:
    """O-11: (key, 1L) pairs with a declared bigint result type."""
    return df.select(F.col(key), F.lit(1).cast("bigint").alias("one"))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    """O-12 / O-17 equality filter (pushed into the parquet scan)."""
    return df.where(F.col(col) == F.lit(value))


def filter_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """O-12 substring filter."""
    return df.where(F.col(col).contains(needle))


def flat_map_by_rule(df: DataFrame, test: Column, when_true: list[str], otherwise: list[str],
                     out: str = "value") -> DataFrame:
    """O-13: each row becomes the listed fields as separate rows — one list
    when ``test`` holds, another otherwise (all fields cast to string)."""
    arr_t = F.array(*[F.col(c).cast("string") for c in when_true])
    arr_f = F.array(*[F.col(c).cast("string") for c in otherwise])
    return df.select(F.explode(F.when(test, arr_t).otherwise(arr_f)).alias(out))


def emit_n(df: DataFrame, value: str, times: Column, out: str = "value") -> DataFrame:
    """O-14: process function as a 0..n emitter; ``times`` gives n per row."""
    return df.select(F.explode(F.array_repeat(F.col(value), times.cast("int"))).alias(out))


def rich_map(df: DataFrame, open_fn: Callable[[], object], map_fn: Callable[[object, pd.DataFrame], pd.DataFrame],
             close_fn: Callable[[object], None], schema: str | T.StructType) -> DataFrame:
    """O-15: per-task open / map / close.

    ``open_fn`` runs once per task before the first Arrow batch, ``close_fn``
    once after the last; ``map_fn(resource, batch)`` maps each batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        res = open_fn()
        try:
            for b in batches:
                yield map_fn(res, b)
        finally:
            close_fn(res)
    return df.mapInPandas(run, schema)


def encode_string(df: DataFrame, fmt: str, *cols: str | Column, out: str = "line") -> DataFrame:
    """O-09: row -> one string (``format_string``)."""
    return df.select(F.format_string(fmt, *cols).alias(out))


class MergeableAggregate:
    """O-19: a user-defined aggregate of four steps.  ``add`` takes a pandas frame
    of rows of one group, ``merge`` two accumulators; accumulators are pickled.
    ``add_groups`` may be overridden where groups are many and small."""

    def create(self):
        raise NotImplementedError

    def add(self, acc, rows: pd.DataFrame):
        raise NotImplementedError

    def add_groups(self, accs: list, rows: pd.DataFrame, at: np.ndarray) -> list:
        """``accs`` with the rows of each group added: those of group i begin at ``at[i]`` and end where the next's begin."""
        return [self.add(acc, rows.iloc[a:b]) for acc, a, b in zip(accs, at, [*at[1:], len(rows)])]

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc):
        raise NotImplementedError


class MeanOf(MergeableAggregate):
    """Mean of a column, nulls skipped; null without values."""

    def __init__(self, col: str):
        self.col = col

    def create(self):
        return 0.0, 0

    def add(self, acc, rows):
        v = rows[self.col]
        return acc[0] + float(v.sum()), acc[1] + int(v.count())

    def add_groups(self, accs, rows, at):
        v = rows[self.col].groupby(np.repeat(np.arange(len(at)), np.diff(at, append=len(rows))))
        return [(a + float(s), n + int(m)) for (a, n), s, m in zip(accs, v.sum(), v.count())]

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, acc):
        return acc[0] / acc[1] if acc[1] else None


class RowsPerDistinct(MergeableAggregate):
    """(rows, distinct values of a column): an accumulator that holds a set."""

    def __init__(self, col: str):
        self.col = col

    def create(self):
        return 0, frozenset()

    def add(self, acc, rows):
        return acc[0] + len(rows), acc[1] | frozenset(rows[self.col].dropna().unique().tolist())

    def add_groups(self, accs, rows, at):
        code, values = pd.factorize(rows[self.col])
        values, n = values.tolist(), np.diff(at, append=len(rows))
        known = code >= 0
        pairs = np.unique(np.repeat(np.arange(len(at)), n)[known] * len(values) + code[known])
        group, code = np.divmod(pairs, max(len(values), 1))
        cuts, code = np.searchsorted(group, np.arange(len(at) + 1)).tolist(), code.tolist()
        return [(m + k, seen.union(values[c] for c in code[a:b])) for (m, seen), k, a, b in zip(accs, n.tolist(), cuts, cuts[1:])]

    def merge(self, a, b):
        return a[0] + b[0], a[1] | b[1]

    def result(self, acc):
        return acc[0] / len(acc[1]) if acc[1] else None


MAX_OPEN_GROUPS = 10_000


def partial_accumulators(df: DataFrame, keys: list[str], cols: list[str], agg: MergeableAggregate) -> DataFrame:
    """keys, ``_acc``: each task adds its rows to one accumulator per group (at most
    ``MAX_OPEN_GROUPS`` at a time), so a group costs a row per task."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_groups: dict[tuple, object] = {}

        def told():
            arrays = [pa.array(list(c), schema.field(k).type) for k, c in zip(keys, zip(*open_groups))]
            accs = pa.array([pickle.dumps(a) for a in open_groups.values()], pa.binary())
            return pa.RecordBatch.from_arrays([*arrays, accs], names=[*keys, "_acc"])

        schema = None
        for batch in batches:
            schema = schema or batch.schema
            if not batch.num_rows:
                continue
            rows, ids = batch.select(cols).to_pandas(), {}
            code = np.array([ids.setdefault(k, len(ids)) for k in zip(*(batch.column(c).to_pylist() for c in keys))])
            order = np.argsort(code, kind="stable")
            at = np.searchsorted(code[order], np.arange(len(ids)))
            accs = [open_groups[k] if k in open_groups else agg.create() for k in ids]
            open_groups.update(zip(ids, agg.add_groups(accs, rows.iloc[order], at)))
            if len(open_groups) > MAX_OPEN_GROUPS:
                yield told()
                open_groups.clear()
        if open_groups:
            yield told()

    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("_acc", T.BinaryType())])
    return df.select(*dict.fromkeys([*keys, *cols])).mapInArrow(partial, schema)


def _one_nan(key: tuple) -> tuple:
    """NaN as a value that equals itself, as in Spark's grouping."""
    return tuple("NaN" if v != v else v for v in key)


def merge_accumulators(parts: DataFrame, keys: list[str], agg: MergeableAggregate, result: str, out: str) -> DataFrame:
    """keys, ``out``: the result of each group's merged accumulators.  Tasks read them sorted by group, so a
    group is one stretch and costs no call of its own; one accumulator is merged into at a time."""
    value = T._parse_datatype_string(result)
    value_type = to_arrow_type(value)
    floats = any(isinstance(parts.schema[k].dataType, (T.FloatType, T.DoubleType)) for k in keys)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur, acc, types = None, None, None  # cur: what the open group is known by, and its key

        def told(groups):
            arrays = [pa.array(list(c), t) for t, c in zip(types, zip(*(k for k, _ in groups)))]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([v for _, v in groups], value_type)], names=[*keys, out])

        for batch in batches:
            types, done = [batch.schema.field(k).type for k in keys], []
            rows = zip(zip(*(batch.column(k).to_pylist() for k in keys)), batch.column("_acc").to_pylist())
            for name, group in itertools.groupby(rows, key=lambda r: _one_nan(r[0]) if floats else r[0]):
                key, first = next(group)
                if cur is None or cur[0] != name:
                    if cur is not None:
                        done.append((cur[1], agg.result(acc)))
                    cur, acc = (name, key), agg.create()
                acc = agg.merge(acc, pickle.loads(first))
                for _, a in group:
                    acc = agg.merge(acc, pickle.loads(a))
            if done:
                yield told(done)
        if cur is not None:
            yield told([(cur[1], agg.result(acc))])

    schema = T.StructType([*(parts.schema[k] for k in keys), T.StructField(out, value)])
    return parts.select(*keys, "_acc").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merged, schema)


def user_aggregate(df: DataFrame, key: str | list[str], cols: list[str], agg: MergeableAggregate,
                   result: str, out: str = "value") -> DataFrame:
    """O-19: ``agg`` per key; ``result`` is the SQL type of ``agg.result``.  Only
    accumulators are shuffled and merged.  Null keys are a group."""
    keys = [key] if isinstance(key, str) else list(key)
    return merge_accumulators(partial_accumulators(df, keys, cols, agg), keys, agg, result, out)
