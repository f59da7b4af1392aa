"""State and timers of many keys at once, with ``transformWithStateInPandas``.

Keys are dealt to ``groups`` by hash, and a processor turns once per group and micro-batch, not once per key: it
reads the group's open rows (one value state, as Arrow), takes the new ones with pandas, tells what is due and keeps
the rest.  Calls between Spark and Python are then per group; rows and keys cost array work only.  A group has one
event-time timer, at the first time at which one of its rows is due; it is moved when that changes and deleted when
nothing is open.  A task holds one group's open and new rows, so ``groups`` bounds its memory; the number is part of
a query's checkpoint, like that of its shuffle partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.operators.scan import _as_key, _as_text

DEFAULT_GROUPS = 1024

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def on_rocksdb(d: DataFrame) -> DataFrame:
    """``d``, with the session's state store switched to RocksDB if it is another one: the
    operator requires it (multiple state variables per key)."""
    spark, key = d.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in (spark.conf.get(key, None) or ""):
        spark.conf.set(key, _ROCKSDB)
    return d


def codes(rows: pd.DataFrame) -> np.ndarray:
    """A number for each of the frame's keys, by first appearance."""
    return pd.factorize(rows["k"])[0]


def starts(*sorted_by: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before, the first row included."""
    differs = np.zeros(len(sorted_by[0]), bool)
    differs[:1] = True
    for c in sorted_by:
        differs[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(differs)


class KeyGroups(StatefulProcessor):
    """``columns`` are the state's; keys are texts that are never null (``_as_text``)."""

    columns: tuple[str, ...] = ()

    def fresh(self, rows: pd.DataFrame, now: int) -> pd.DataFrame:
        """A micro-batch's rows as rows of the state's ``columns``."""
        raise NotImplementedError

    def advance(self, rows: pd.DataFrame, known: int, now: int) -> tuple[Iterator[pd.DataFrame] | list[pd.DataFrame], pd.DataFrame, int | None]:
        """Of the group's rows, ``known`` held ones and then the new ones: what to tell at
        watermark ``now``, the rows to keep, and when to be asked again."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary")

    def _turn(self, new: pd.DataFrame | None, now: int, fired: int | None = None) -> Iterator[pd.DataFrame]:
        was = self.held.get()
        parts = [] if was is None else [pa.ipc.open_stream(was[0]).read_pandas()]
        known = sum(map(len, parts))
        if new is not None:
            parts.append(self.fresh(new, now))
        if not sum(map(len, parts)):
            return iter([])
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        out, rest, due = self.advance(rows[list(self.columns)], known, now)
        if len(rest):
            self.held.update((self._packed(rest),))
        elif was is not None:
            self.held.clear()
        timers = set(self.handle.listTimers())
        for t in timers - {due, fired}:
            self.handle.deleteTimer(t)
        if due is not None and due not in timers:
            self.handle.registerTimer(due)
        return (frame for frame in out if len(frame))

    def _packed(self, rows: pd.DataFrame) -> bytes:
        batch = pa.RecordBatch.from_arrays([pa.array(rows[c]) for c in self.columns], names=list(self.columns))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return self._turn(pd.concat(list(rows), ignore_index=True), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._turn(None, timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def flagged(col: str | Column, kind: str, name: str, empty) -> list[Column]:
    """``name`` of type ``kind`` without nulls and ``has_name``: pandas would turn long integers with nulls into floats,
    and make nulls of floats NaN."""
    c = F.col(col) if isinstance(col, str) else col
    return [F.coalesce(c.cast(kind), F.lit(empty).cast(kind)).alias(name), c.isNotNull().alias(f"has_{name}")]


def grouped_state(d: DataFrame, processor: KeyGroups, schema: str, groups: int = DEFAULT_GROUPS) -> DataFrame:
    """``k`` as in ``d`` and ``schema``'s columns, of a stream with a key ``k``, ``ms`` and a watermark.  A column
    of ``schema`` with a ``has_`` one beside it is null where that is false."""
    kind = d.schema["k"].dataType
    dealt = d.withColumn("k", _as_text("k")).withColumn("g", F.pmod(F.xxhash64("k"), F.lit(groups)).cast("int"))
    out = on_rocksdb(dealt).groupBy("g").transformWithStateInPandas(processor, f"k string, {schema}", "Append", "EventTime")
    names = [c for c in out.columns if c != "k" and not c.startswith("has_")]
    return out.select(_as_key("k", kind).alias("k"), *[
        F.when(F.col(f"has_{c}"), F.col(c)).alias(c) if f"has_{c}" in out.columns else F.col(c) for c in names])
