"""Timers that are listed, moved and deleted (O-75) and state whose single entries expire (O-77), with ``transformWithState``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.time import duration_us
from tideline.streaming.groups import DEFAULT_GROUPS, KeyGroups, codes, grouped_state
from tideline.streaming.stateful import DEFAULT_SLOT, _arranged, _in_order, keyed_state, with_watermark


class Debounce(KeyGroups):
    """Open bursts of a key as (first, last, rows), disjoint.  A burst is due ``quiet`` after its last row; rows that
    extend or join bursts move that, and the group's timer with it."""

    columns = ("k", "first", "last", "n")

    def __init__(self, quiet_ms: int):
        self.quiet = quiet_ms

    def fresh(self, rows, now):
        return pd.DataFrame({"k": rows["k"], "first": rows["ms"], "last": rows["ms"], "n": np.int64(1)})

    def advance(self, rows, known, now):
        code = codes(rows)
        order = np.lexsort((rows["last"], rows["first"], code))
        rows, code = rows.iloc[order], code[order]
        last = rows["last"].to_numpy()
        reach = rows["last"].groupby(code).cummax().to_numpy()
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (code[1:] != code[:-1]) | (rows["first"].to_numpy()[1:] - reach[:-1] >= self.quiet)
        at = np.flatnonzero(fresh)
        bursts = rows.iloc[at].assign(last=np.maximum.reduceat(last, at), n=np.add.reduceat(rows["n"].to_numpy(), at))
        fire = bursts["last"] + self.quiet
        told, rest = bursts[fire <= now], bursts[fire > now]
        out = pd.DataFrame({"k": told["k"], "first_ms": told["first"], "fire_ms": told["last"] + self.quiet, "cnt": told["n"]})
        return [out], rest, int(rest["last"].min()) + self.quiet if len(rest) else None


def debounce_stream(df: DataFrame, key: str, ts: str, quiet: str, delay: str = "0 seconds", groups: int = DEFAULT_GROUPS) -> DataFrame:
    """O-75: one row (k, first_ms, fire_ms, cnt) for each burst of a key, when ``quiet`` has passed since its
    last row in event time.  A row less than ``quiet`` after another is of the same burst and moves its timer,
    whatever order the rows arrive in within the watermark.  State is a row per open burst.  Null keys are a
    key, rows without a time are left out."""
    d = with_watermark(df, key, ts, delay, [])
    return grouped_state(d, Debounce(duration_us(quiet) // 1000), "first_ms long, fire_ms long, cnt long", groups)


class RecentlySeen(StatefulProcessor):
    """Map state item -> id of its first row and list state of rows, every entry with its own expiry.
    What has expired is looked up once per micro-batch."""

    def __init__(self, ttl_ms: int, refresh_on_read: bool):
        self.ttl, self.refresh = ttl_ms, refresh_on_read

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getMapState("items", "item string, present boolean", "id long", ttlDurationMs=self.ttl)
        self.recent = handle.getListState("recent", "id long", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        first: dict[str | None, int | None] = {}
        out, new = [], []
        for r in _in_order(rows):
            if r.item not in first:
                at = (r.item or "", r.item is not None)
                known = self.items.containsKey(at)
                first[r.item] = self.items.getValue(at)[0] if known else r.tb
                if self.refresh or not known:
                    self.items.updateValue(at, (first[r.item],))
            new.append((r.tb,))
            out.append(Row(k=key[0], tb=r.tb, item=r.item, first_id=first[r.item], recent_rows=len(held) + len(new)))
        if self.refresh:
            self.recent.put(held + new)
        else:
            self.recent.appendList(new)
        return iter(out)

    def close(self) -> None:
        pass


def recently_seen_stream(df: DataFrame, key: str, ts: str, item: str, tiebreak: str, ttl: str, refresh_on_read: bool = False,
                         delay: str | None = None, slot: str = DEFAULT_SLOT) -> DataFrame:
    """O-77: for each row (k, tb, item, first_id, recent_rows): the id of the first row of this item that the key
    still remembers, and how many of the key's rows it remembers, this one included.  An entry is forgotten
    ``ttl`` of processing time after it was written, or with ``refresh_on_read`` after it was last read.  State is
    bounded by what a key receives within ``ttl``.  Null keys and null items count like others."""
    d = _arranged(df.withColumn(tiebreak, F.col(tiebreak).cast("long")), key, ts, tiebreak, delay, slot, {"item": F.col(item).cast("string")})
    schema = f"k {df.schema[key].dataType.simpleString()}, tb long, item string, first_id long, recent_rows long"
    return keyed_state(d, RecentlySeen(duration_us(ttl) // 1000, refresh_on_read), schema, "ProcessingTime")
