"""Per-key state and timers on streams with ``transformWithState``
(O-37, O-57, O-68, O-73, O-74, O-76…O-80).

Each processor keeps only the state its key needs (RocksDB state store,
checkpointed); event-time timers fire once the watermark passes them.  Callbacks
use the keyword names Spark passes (``timerValues``, ``expiredTimerInfo``).

Row order follows one rule, so that results don't depend on how the input is cut
into micro-batches.  Without ``delay``, rows are taken in arrival order, which the
tiebreak column numbers.  With ``delay``, they are taken in (time, tiebreak) order:
a built-in windowed aggregation holds them until the watermark has passed the end
of their ``slot``, and rows later than the watermark are dropped.  The operators
with timers (periodic count, followed-by) hold their rows in own state until the
watermark has passed them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.time import duration_us, epoch_ms, event_time
from tideline.streaming.groups import DEFAULT_GROUPS, KeyGroups, codes, flagged, grouped_state, on_rocksdb, starts


def _ms(v) -> int:
    return int(v)


def keyed_state(d: DataFrame, processor: StatefulProcessor, schema: str, time_mode: str, keys: tuple | list = ("k",), event_time: str = "") -> DataFrame:
    """``groupBy(keys).transformWithState`` on the RocksDB state store, which the
    operator requires (multiple state variables per key); the session's
    provider is switched only if it is another one.  ``event_time`` names the
    output's time column where another stateful step follows."""
    return on_rocksdb(d).groupBy(*keys).transformWithState(processor, schema, "Append", time_mode, eventTimeColumnName=event_time)


def with_watermark(df: DataFrame, key: str, ts: str, delay: str, cols: list) -> DataFrame:
    """key, ms (epoch ms of ts), event time with watermark, extra columns.  Rows
    without a time are left out; they have no part in the watermark either."""
    d = df.select(F.col(key).alias("k"), epoch_ms(ts).alias("ms"), event_time(ts).alias("et"), *cols)
    return d.withWatermark("et", f"{duration_us(delay)} microseconds").where(F.col("et").isNotNull())


DEFAULT_SLOT = "1 minute"


def _arranged(df: DataFrame, key: str, ts: str, tiebreak: str, delay: str | None, slot: str, cols: dict) -> DataFrame:
    """k, o (what to sort a key's micro-batch by), ms, tb and ``cols``: see the module's rule."""
    d = df.select(F.col(key).alias("k"), epoch_ms(ts).alias("ms"), F.col(tiebreak).alias("tb"), *[c.alias(n) for n, c in cols.items()],
                  *([] if delay is None else [event_time(ts).alias("et")]))
    names = ["ms", "tb", *cols]
    if delay is None:
        return d.select("k", F.lit(0).cast("long").alias("o"), *names)
    d = d.withWatermark("et", f"{duration_us(delay)} microseconds")
    held = d.groupBy("k", F.window("et", f"{duration_us(slot)} microseconds").alias("w")).agg(F.collect_list(F.struct(*names)).alias("rows"))
    return held.select("k", F.explode("rows").alias("r")).select("k", F.col("r.ms").alias("o"), *[F.col(f"r.{n}").alias(n) for n in names])


def _in_order(rows) -> list:
    """Nulls come first, as Spark sorts them."""
    return sorted(rows, key=lambda r: (r.o, r.tb is not None, 0 if r.tb is None else r.tb))


class EventTimeTimer(KeyGroups):
    """O-73: every row sets a timer at ``ms + after`` for its key, equal ones once; the
    timer reports the key and its time once the watermark passes it."""

    columns = ("k", "timer_ms")

    def __init__(self, after_ms: int):
        self.after = after_ms

    def fresh(self, rows, now):
        return pd.DataFrame({"k": rows["k"], "timer_ms": rows["ms"] + self.after})

    def advance(self, rows, known, now):
        rows = rows.drop_duplicates()
        rest = rows[rows["timer_ms"] > now]
        return [rows[rows["timer_ms"] <= now]], rest, int(rest["timer_ms"].min()) if len(rest) else None


def event_time_timers(df: DataFrame, key: str, ts: str, after: str, delay: str = "0 seconds", groups: int = DEFAULT_GROUPS) -> DataFrame:
    d = with_watermark(df, key, ts, delay, [])
    return grouped_state(d, EventTimeTimer(duration_us(after) // 1000), "timer_ms long", groups)


class ProcessingTimeTimer(StatefulProcessor):
    """O-74: a timer ``after`` ms of processing time after each row arrives."""

    def __init__(self, after_ms: int):
        self.after = after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for _ in rows:
            self.handle.registerTimer(now + self.after)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(k=key[0], timer_ms=expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


class PeriodicCount(StatefulProcessor):
    """O-76: cumulative count per key, reported ``interval`` after the first
    row since the last report (count of rows with ts <= fire time).  Rows are
    held until the watermark has passed them and counted in time order."""

    def __init__(self, interval_ms: int):
        self.iv = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "c long, f long")  # f: next report, -1 if none is due
        self.pending = handle.getListState("pending", "ms long")

    def _advance(self, key, new, now) -> list[Row]:
        cnt, fire = self.count.get() if self.count.exists() else (0, -1)
        held = ([t[0] for t in self.pending.get()] if self.pending.exists() else []) + new
        out = []
        for m in sorted(x for x in held if x <= now):
            if 0 <= fire < m:
                out.append(Row(k=key[0], fire_ms=fire, cnt=cnt))
                fire = -1
            if fire < 0:
                fire = m + self.iv
            cnt += 1
        if 0 <= fire <= now:
            out.append(Row(k=key[0], fire_ms=fire, cnt=cnt))
            fire = -1
        rest = [x for x in held if x > now]
        if rest or self.pending.exists():
            self.pending.clear()
        if rest:
            self.pending.put([(m,) for m in rest])
        self.count.update((cnt, fire))
        due = min([*rest, *([fire] if fire >= 0 else [])], default=None)
        if due is not None:
            self.handle.registerTimer(due)
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return iter(self._advance(key, [_ms(r.ms) for r in rows], timerValues.getCurrentWatermarkInMs()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter(self._advance(key, [], timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass


def periodic_count_stream(df: DataFrame, key: str, ts: str, interval: str, delay: str = "0 seconds") -> DataFrame:
    d = with_watermark(df, key, ts, delay, [])
    return keyed_state(d, PeriodicCount(duration_us(interval) // 1000),
                                              f"k {df.schema[key].dataType.simpleString()}, fire_ms long, cnt long",
                                              "EventTime")


class ChangelogCount(StatefulProcessor):
    """O-57: +I / -U / +U rows of a running count per key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "c long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        c = self.count.get()[0] if self.count.exists() else 0
        out = []
        for r in _in_order(rows):
            if c == 0:
                out.append(Row(k=key[0], tb=r.tb, op="+I", cnt=1))
            else:
                out.append(Row(k=key[0], tb=r.tb, op="-U", cnt=c))
                out.append(Row(k=key[0], tb=r.tb, op="+U", cnt=c + 1))
            c += 1
        self.count.update((c,))
        return iter(out)

    def close(self) -> None:
        pass


def changelog_stream(df: DataFrame, key: str, ts: str, tiebreak: str, delay: str | None = None, slot: str = DEFAULT_SLOT) -> DataFrame:
    d = _arranged(df, key, ts, tiebreak, delay, slot, {})
    kt, tt = df.schema[key].dataType.simpleString(), df.schema[tiebreak].dataType.simpleString()
    return keyed_state(d, ChangelogCount(), f"k {kt}, tb {tt}, op string, cnt long",
                                              "None")


class FirstNAverage(StatefulProcessor):
    """O-37: integer mean of the first n epoch-ms values per key, once; null times are skipped."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", "s long, c long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        s, c = self.acc.get() if self.acc.exists() else (0, 0)
        out = []
        for r in _in_order(r for r in rows if r.ms is not None) if c < self.n else ():
            s, c = s + _ms(r.ms), c + 1
            if c == self.n:
                out.append(Row(k=key[0], avg_ms=s // self.n))
                break
        self.acc.update((s, c))
        return iter(out)

    def close(self) -> None:
        pass


def first_n_average_stream(df: DataFrame, key: str, ts: str, tiebreak: str, n: int = 5, delay: str | None = None,
                           slot: str = DEFAULT_SLOT) -> DataFrame:
    """O-37 on a stream: the first rows in arrival order (``tiebreak``), or with a ``delay`` in event-time order."""
    d = _arranged(df, key, ts, tiebreak, delay, slot, {})
    return keyed_state(d, FirstNAverage(n), f"k {df.schema[key].dataType.simpleString()}, avg_ms long", "None")


class StateMachine(StatefulProcessor):
    """O-78 / O-80: transition table per key; emits the row that reaches
    ``accept`` (state then stays), ``reset`` and unknown symbols go back to
    ``initial``."""

    def __init__(self, transitions, initial, accept, reset):
        self.table = {(s, a): n for s, a, n in transitions}
        self.initial, self.accept, self.reset = initial, accept, reset

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "s string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        st = self.state.get()[0] if self.state.exists() else self.initial
        out = []
        for r in _in_order(rows):
            nxt = self.table.get((st, r.sym), self.initial)
            if nxt == self.accept:
                out.append(Row(k=key[0], tb=r.tb, ms=r.ms))
            elif nxt == self.reset:
                st = self.initial
            else:
                st = nxt
        self.state.update((st,))
        return iter(out)

    def close(self) -> None:
        pass


def state_machine_stream(df: DataFrame, key: str, ts: str, symbol: str, tiebreak: str, transitions,
                         initial: str, accept: str, reset: str, delay: str | None = None, slot: str = DEFAULT_SLOT) -> DataFrame:
    d = _arranged(df, key, ts, tiebreak, delay, slot, {"sym": F.col(symbol)})
    kt, tt = df.schema[key].dataType.simpleString(), df.schema[tiebreak].dataType.simpleString()
    return keyed_state(d, StateMachine(transitions, initial, accept, reset),
                                              f"k {kt}, tb {tt}, ms long", "None")


class FollowedByWithin(KeyGroups):
    """O-79: start rows wait for an end row after them, strictly less than
    ``within`` ms later; an end row matches every waiting start; a start whose
    time (start + within) passes the watermark first is reported as timed out.
    Rows are held until the watermark has passed them and taken in time order,
    those of equal time by id, null ids first; ``waiting`` marks starts that were taken."""

    columns = ("k", "ms", "id", "has_id", "is_start", "is_end", "waiting")

    def __init__(self, within_ms: int):
        self.within = within_ms

    def fresh(self, rows, now):
        return rows[rows["is_start"] | rows["is_end"]].assign(waiting=False)[list(self.columns)]

    def advance(self, rows, known, now):
        code = codes(rows)
        order = np.lexsort((rows["id"], rows["has_id"], rows["ms"], ~rows["waiting"], code))
        taken = rows["ms"].to_numpy()[order] <= now
        later, rows, code = rows.iloc[order[~taken]], rows.iloc[order[taken]], code[order[taken]]
        n, ms = len(rows), rows["ms"].to_numpy()
        # the first end row after each row: the least position of one from the next row on
        ends = np.append(np.where(rows["is_end"], np.arange(n), n), n)
        end = np.minimum.accumulate(ends[::-1])[::-1][1:]
        there = np.minimum(end, max(n - 1, 0))
        start = rows["is_start"].to_numpy()
        matched = start & (end < n) & (code[there] == code) & (ms[there] - ms < self.within)
        timeout = start & ~matched & (ms + self.within <= now)
        at = np.flatnonzero(matched | timeout)
        found, to = rows.iloc[at], rows.iloc[there[at]]
        out = pd.DataFrame({"k": found["k"].to_numpy(), "start_id": found["id"].to_numpy(), "has_start_id": found["has_id"].to_numpy(), "start_ms": ms[at],
                            "end_id": to["id"].to_numpy(), "has_end_id": to["has_id"].to_numpy() & matched[at], "end_ms": to["ms"].to_numpy(),
                            "has_end_ms": matched[at], "status": np.where(matched[at], "matched", "timeout")})
        waiting = rows[start & ~matched & ~timeout].assign(is_end=False, waiting=True)
        due = [int(x) for x in ([later["ms"].min()] if len(later) else []) + ([waiting["ms"].min() + self.within] if len(waiting) else [])]
        return [out], pd.concat([waiting, later]), min(due, default=None)


def followed_by_stream(df: DataFrame, key: str, ts: str, is_start, is_end, within: str, id_col: str,
                       delay: str = "0 seconds", groups: int = DEFAULT_GROUPS) -> DataFrame:
    # no filter here: Catalyst would push it below the watermark, which must
    # follow every row of the stream; the processor skips other rows
    flags = [F.coalesce(c, F.lit(False)).alias(n) for n, c in (("is_start", is_start), ("is_end", is_end))]
    d = with_watermark(df, key, ts, delay, [*flagged(id_col, "long", "id", 0), *flags])
    return grouped_state(d, FollowedByWithin(duration_us(within) // 1000),
                         "start_id long, has_start_id boolean, start_ms long, end_id long, has_end_id boolean, "
                         "end_ms long, has_end_ms boolean, status string", groups)


class PreviousValue(StatefulProcessor):
    """O-68 first half: each row with the previous symbol of its key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("prev", "p string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        p = self.prev.get()[0] if self.prev.exists() else None
        out = []
        for r in _in_order(rows):
            out.append(Row(k=key[0], tb=r.tb, prev_action=p, action=r.sym))
            p = r.sym
        self.prev.update((p,))
        return iter(out)

    def close(self) -> None:
        pass


def rule_matches_stream(df: DataFrame, key: str, ts: str, action: str, tiebreak: str, rules: DataFrame,
                        delay: str | None = None, slot: str = DEFAULT_SLOT) -> DataFrame:
    """O-68 on a stream: previous action from state, then a stream-static join
    with the rules table."""
    d = _arranged(df, key, ts, tiebreak, delay, slot, {"sym": F.col(action)})
    kt, tt = df.schema[key].dataType.simpleString(), df.schema[tiebreak].dataType.simpleString()
    pairs = keyed_state(d, PreviousValue(), f"k {kt}, tb {tt}, prev_action string, action string",
                                              "None")
    r = rules.select(F.col("action1").alias("prev_action"), F.col("action2").alias("action"))
    return pairs.join(r, on=["prev_action", "action"], how="inner")


class LastSeenTTL(StatefulProcessor):
    """O-77: per-key value with a time-to-live (processing time); an expired
    value is never returned."""

    def __init__(self, ttl_ms: int):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "v string", ttlDurationMs=self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        prev = self.last.get()[0] if self.last.exists() else None
        last = None
        for r in rows:
            last = r.sym
        self.last.update((last,))
        yield Row(k=key[0], previous=prev, current=last)

    def close(self) -> None:
        pass


def _sum(values: list) -> float | None:
    """Nulls are skipped; null without values."""
    known = [v for v in values if v is not None]
    return float(sum(known)) if known else None


class CountWindow(StatefulProcessor):
    """O-48 on a stream: after every ``step``-th row of a key, the count and
    sum of its last ``size`` rows (tumbling when step == size, which emits
    only complete blocks).  List state holds at most ``size`` recent values."""

    def __init__(self, size: int, step: int, tumbling: bool):
        self.size, self.step, self.tumbling = size, step, tumbling

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "v double")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        recent = [t[0] for t in self.recent.get()] if self.recent.exists() else []
        n = self.seen.get()[0] if self.seen.exists() else 0
        out = []
        for r in _in_order(rows):
            n += 1
            recent.append(r.v)
            recent = recent[-self.size:]
            if n % self.step == 0:
                out.append(Row(k=key[0], fire_seq=n, cnt=len(recent), total=_sum(recent)))
                if self.tumbling:
                    recent = []
        self.recent.clear()
        if recent:
            self.recent.put([(v,) for v in recent])
        self.seen.update((n,))
        return iter(out)

    def close(self) -> None:
        pass


def count_window_stream(df: DataFrame, key: str, ts: str, value: str, tiebreak: str, size: int,
                        step: int | None = None, delay: str | None = None, slot: str = DEFAULT_SLOT) -> DataFrame:
    step = step or size
    d = _arranged(df, key, ts, tiebreak, delay, slot, {"v": F.col(value).cast("double")})
    kt = df.schema[key].dataType.simpleString()
    return keyed_state(d, CountWindow(size, step, step == size),
                                              f"k {kt}, fire_seq long, cnt long, total double", "None")


class StrictSequence(StatefulProcessor):
    """O-78 on a stream: k consecutive rows of a key matching k step flags
    (``_m0`` … ``_m{k-1}``); keeps the last k-1 rows in list state.
    Overlapping matches are all reported."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", "tb long, flags array<boolean>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = [(t[0], list(t[1])) for t in self.last.get()] if self.last.exists() else []
        out = []
        for r in _in_order(rows):
            flags = [bool(getattr(r, f"_m{j}")) for j in range(self.k)]
            window = (last + [(r.tb, flags)])[-self.k:]
            if len(window) == self.k and all(window[j][1][j] for j in range(self.k)):
                out.append(Row(k=key[0], ids=[w[0] for w in window]))
            last = window[-(self.k - 1):] if self.k > 1 else []
        self.last.clear()
        if last:
            self.last.put(last)
        return iter(out)

    def close(self) -> None:
        pass


def strict_sequence_stream(df: DataFrame, key: str, ts: str, tiebreak: str, steps: list, delay: str | None = None,
                           slot: str = DEFAULT_SLOT) -> DataFrame:
    d = _arranged(df.withColumn(tiebreak, F.col(tiebreak).cast("long")), key, ts, tiebreak, delay, slot, {f"_m{j}": c for j, c in enumerate(steps)})
    kt = df.schema[key].dataType.simpleString()
    return keyed_state(d, StrictSequence(len(steps)), f"k {kt}, ids array<long>", "None")


def current_watermark_ms(query) -> int | None:
    """O-58: the watermark a running query has reached (from its progress)."""
    p = query.lastProgress
    wm = (p or {}).get("eventTime", {}).get("watermark")
    if not wm:
        return None
    import datetime
    t = datetime.datetime.strptime(wm.replace("Z", ""), "%Y-%m-%dT%H:%M:%S.%f")
    return int((t - datetime.datetime(1970, 1, 1)).total_seconds() * 1000)


class KeepLastWindow(KeyGroups):
    """O-52 on a stream: tumbling window per key that keeps only its last
    ``n`` rows (evictor) and reports their count and sum when the watermark
    passes the window end.  State: the last n (ms, tb, v) of each open window ``w``."""

    columns = ("k", "w", "ms", "tb", "has_tb", "v", "has_v")

    def __init__(self, size_ms: int, n: int):
        self.size, self.n = size_ms, n

    def fresh(self, rows, now):
        return rows.assign(w=rows["ms"] - rows["ms"] % self.size)[list(self.columns)]

    def advance(self, rows, known, now):
        code = codes(rows)
        order = np.lexsort((rows["tb"], rows["has_tb"], rows["ms"], rows["w"], code))
        rows, at = rows.iloc[order], starts(code[order], rows["w"].to_numpy()[order])
        size = np.diff(at, append=len(rows))
        rows = rows[np.repeat(at + size, size) - np.arange(len(rows)) <= self.n]
        size = np.minimum(size, self.n)
        at = np.cumsum(size) - size
        total, some = (np.add.reduceat(x.to_numpy(), at) for x in (rows["v"].where(rows["has_v"], 0.0), rows["has_v"].astype(int)))
        wins = rows.iloc[at]
        ended = wins["w"].to_numpy() + self.size <= now
        out = pd.DataFrame({"k": wins["k"], "window_start_ms": wins["w"], "cnt": size, "total": total, "has_total": some > 0})[ended]
        rest = rows[np.repeat(~ended, size)]
        return [out], rest, int(rest["w"].min()) + self.size if len(rest) else None


def keep_last_stream(df: DataFrame, key: str, ts: str, value: str, tiebreak: str, size: str, n: int,
                     delay: str = "0 seconds", groups: int = DEFAULT_GROUPS) -> DataFrame:
    d = with_watermark(df, key, ts, delay, [*flagged(tiebreak, "long", "tb", 0), *flagged(value, "double", "v", 0.0)])
    return grouped_state(d, KeepLastWindow(duration_us(size) // 1000, n),
                         "window_start_ms long, cnt long, total double, has_total boolean", groups)
