"""Sequential per-key operators (O-76, O-80).

Some semantics are a fold over a key's rows in time order where each step
depends on the state before it (a timer anchored at the first row after the
last firing; a state machine).  A key's rows are cut into buckets of about
``target_rows`` neighbouring rows (``sequence.with_split``); tasks work on
(key, bucket) stretches with numpy, and what a bucket does to the state is
composed across buckets by joins, so no task ever holds a key.  The plan is the
same for every input; a key within the target is one bucket.

``periodic_count``: rows of equal time count together.  In a bucket the next
anchor of every row is one ``searchsorted``, and the bucket's last firing for
every possible first anchor follows by doubling those jumps.  Its successor is
the first row after that firing (an as-of lookup by time slot), and the real
chain of buckets' first anchors is found by doubling the successors.

``run_state_machine``: a step is a function on a small set of states, and
functions compose.  Prefix compositions are computed for blocks of rows at
once, from every state a bucket may be entered in; the composed function of
each bucket gives the true one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us, ntz_from_us
from tideline.operators.sequence import DEFAULT_SLOT, DEFAULT_TARGET_ROWS, with_split


def _as_text(key: str) -> Column:
    """The key as a string that is never null, so that pandas neither turns large
    integers into floats nor null keys into keys that differ from each other."""
    return F.when(F.col(key).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(key).cast("string")))


def _as_key(col: str, kind) -> Column:
    return F.when(F.col(col) != "0", F.substring(col, 2, 2**31 - 1)).cast(kind)


def _starts(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Where the values of ``by`` differ from the row before (the first row isn't told)."""
    n, out = batch.num_rows, None
    for c in by:
        col = batch.column(c)
        differs = pc.not_equal(col.slice(1), col.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        out = differs if out is None else out | differs
    return np.flatnonzero(out) + 1


def _groups(batches: Iterator[pa.RecordBatch], by: list[str], values: list[str]) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """(values of ``by``, arrays of ``values``) of each group of a sorted input."""
    cur, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = [0, *_starts(batch, by).tolist(), batch.num_rows]
        arrays = [batch.column(v).to_numpy(zero_copy_only=False) for v in values]
        for a, b in zip(cuts, cuts[1:]):
            group = tuple(batch.column(c)[a].as_py() for c in by)
            if group != cur:
                if parts:
                    yield cur, [np.concatenate(x) for x in zip(*parts)]
                cur, parts = group, []
            parts.append([x[a:b] for x in arrays])
    if parts:
        yield cur, [np.concatenate(x) for x in zip(*parts)]


# ---- periodic count ------------------------------------------------------------------------------------------------

def next_anchors(t: np.ndarray, interval: int) -> np.ndarray:
    """Index of the first time after t + interval; len(t) without one."""
    return np.searchsorted(t, t + interval, side="right")


def last_anchors(after: np.ndarray) -> np.ndarray:
    """The last anchor of the chain from every row: jumps of 1, 2, 4, … steps until nothing moves."""
    here = np.arange(len(after))
    last = np.where(after < len(after), after, here)
    while (further := last[last]).tobytes() != last.tobytes():
        last = further
    return last


def _exits(rows: DataFrame, interval: int) -> DataFrame:
    """(k, us, bkt, before, exit): the bucket's last firing if the row is its first anchor; before: rows of the bucket at earlier times."""
    def run(batches):
        for (k, bkt), (us, c) in _groups(batches, ["k", "_bkt"], ["us", "c"]):
            exit_ = us[last_anchors(next_anchors(us, interval))] + interval
            n = len(us)
            yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.string()), pa.array(us), pa.array(np.full(n, bkt)), pa.array(np.cumsum(c) - c), pa.array(exit_)],
                                             names=["k", "us", "bkt", "before", "exit"])

    return (rows.select("k", "_bkt", "us", "c").repartition("k", "_bkt").sortWithinPartitions("k", "_bkt", "us")
            .mapInArrow(run, "k string, us long, bkt long, before long, exit long"))


def _first_after(rows: DataFrame, probes: DataFrame, slot: int) -> DataFrame:
    """(k, exit, us): the key's first row after each probe (null without one).

    Looked up inside the probe's time slot, else the next slot that has rows; the only
    ordering over a whole key is that of its slots."""
    s = F.floor(F.col("us") / F.lit(slot)).cast("bigint")
    r = rows.select("k", "us").withColumn("s", s).withColumn("kind", F.lit(0))
    p = probes.select("k", F.col("exit").alias("us")).withColumn("s", s).withColumn("kind", F.lit(1))
    both = r.unionByName(p)
    slots = both.groupBy("k", "s").agg(F.min(F.when(F.col("kind") == 0, F.col("us"))).alias("f"))
    later = Window.partitionBy("k").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("k", "s", F.min("f").over(later).alias("next"))
    above = Window.partitionBy("k", "s").orderBy(F.col("us").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = both.withColumn("in", F.min(F.when(F.col("kind") == 0, F.col("us"))).over(above)).where(F.col("kind") == 1)
    return inside.join(slots, ["k", "s"]).select("k", F.col("us").alias("exit"), F.coalesce("in", "next").alias("us"))


def _path(first: DataFrame, hop: DataFrame) -> DataFrame:
    """(k, us) of all rows on the way from ``first`` over hops (k, us, to): a round doubles the steps known."""
    path = first.checkpoint()
    while True:
        ahead = path.join(hop, ["k", "us"]).where(F.col("to").isNotNull()).select("k", F.col("to").alias("us")).checkpoint()
        if ahead.isEmpty():
            return path
        path = path.unionByName(ahead).checkpoint()
        second = hop.select("k", F.col("us").alias("to"), F.col("to").alias("to2"))
        hop = hop.where(F.col("to").isNotNull()).join(second, ["k", "to"], "left").select("k", "us", F.col("to2").alias("to")).checkpoint()


def _anchors(rows: DataFrame, interval: int, slot: int) -> DataFrame:
    """(k, bkt, us, upto, base) of the first anchor of each bucket that has one, for keys of several buckets;
    upto: the key's rows at or before the bucket's last firing, base: its rows in earlier buckets."""
    exits = _exits(rows, interval).checkpoint()
    to = _first_after(rows, exits.select("k", "exit").distinct(), slot).withColumnRenamed("us", "to")
    hop = exits.join(to, ["k", "exit"]).select("k", "us", "to").checkpoint()
    first = rows.groupBy("k").agg(F.min("us").alias("us"))
    # only rows that some bucket's last firing leads to can be on the way
    entries = hop.select("k", F.col("to").alias("us")).where(F.col("us").isNotNull()).unionByName(first).distinct()
    hop = hop.join(entries, ["k", "us"], "left_semi").checkpoint()
    by_key = Window.partitionBy("k")
    bases = rows.groupBy("k", F.col("_bkt").alias("bkt")).agg(F.sum("c").alias("n"))
    bases = bases.select("k", "bkt", F.sum("n").over(by_key).alias("total"),
                         F.coalesce(F.sum("n").over(by_key.orderBy("bkt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = _path(first, hop).join(exits.select("k", "us", "bkt"), ["k", "us"]).join(bases, ["k", "bkt"]).join(hop, ["k", "us"])
    there = exits.select("k", F.col("us").alias("to"), F.col("bkt").alias("bkt2"), "before").join(
        bases.select("k", F.col("bkt").alias("bkt2"), F.col("base").alias("base2")), ["k", "bkt2"])
    return own.join(there, ["k", "to"], "left").select("k", "bkt", "us", F.coalesce(F.col("base2") + F.col("before"), F.col("total")).alias("upto"), "base")


def periodic_count(df: DataFrame, key: str, ts: str, interval: str, tiebreak: str | None = None,
                   partitions: int | None = None, slot: str | int = "1 second",
                   target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """O-76: per key a timer is set ``interval`` after the first row seen while
    no timer is pending; when it fires it reports the cumulative row count of
    the key (never reset) over rows with ts <= fire time.  At end of input the
    pending timer fires.  Output: key, fire_us (epoch µs), cnt.  Null keys are
    one key; rows with a null time set no timer and aren't counted.  Rows of equal
    time are alike, so ``tiebreak`` has no effect."""
    from tideline.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    iv, kind = duration_us(interval), df.schema[key].dataType
    d = df.where(F.col(ts).isNotNull()).groupBy(_as_text(key).alias("k"), epoch_us(ts).alias("us")).agg(F.count(F.lit(1)).alias("c"))
    d = with_split(d.withColumn("t", ntz_from_us("us")), ["k"], "t", slot, target_rows).select("k", "_bkt", "us", "c", "_last").checkpoint()
    anchors = _anchors(d.where(F.col("_last") > 0), iv, duration_us(slot))
    rows = d.select("k", "_bkt", F.lit(1).alias("kind"), "us", "c", F.when(F.col("_last") > 0, F.lit(-1)).otherwise(F.lit(0)).cast("long").alias("base"))
    marks = anchors.select("k", F.col("bkt").alias("_bkt"), F.lit(0).alias("kind"), "us", F.col("upto").alias("c"), "base")
    d = rows.unionByName(marks)
    d = (d.repartition(partitions, "k", "_bkt") if partitions else d.repartition("k", "_bkt")).sortWithinPartitions("k", "_bkt", "kind", "us")

    def run(batches):
        for (k, _), (kinds, us, c, base) in _groups(batches, ["k", "_bkt"], ["kind", "us", "c", "base"]):
            if kinds[0] == 0:  # the bucket's first anchor
                before, upto, us, pos = int(base[0]), int(c[0]), us[1:], int(np.searchsorted(us[1:], us[0]))
                seen = before + np.cumsum(c[1:])
            elif base[0] == 0:  # a key of one bucket
                pos, seen = 0, np.cumsum(c)
                upto = int(seen[-1])
            else:
                continue
            after, at = next_anchors(us, iv), []
            steps = after.tolist()
            while pos < len(steps):
                at.append(pos)
                pos = steps[pos]
            at = np.array(at)
            counts = np.r_[seen[after[at[:-1]] - 1], upto]
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(us[at] + iv), pa.array(counts.astype(np.int64))], names=["k", "fire_us", "cnt"])

    return d.mapInArrow(run, "k string, fire_us long, cnt long").select(_as_key("k", kind).alias(key), "fire_us", "cnt")


# ---- state machine -------------------------------------------------------------------------------------------------

BLOCK = 64


def prefix_states(symbol: np.ndarray, start: np.ndarray, step: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, after): the state before and after each row for every state in which its stretch may be
    entered.  ``step``: (symbols, states) next states; ``start``: rows that begin a stretch; ``entry``: states at
    the first row, should it continue one.

    Rows are cut into blocks of ``BLOCK``; all blocks advance together row by row, then the
    blocks' compositions are chained by doubling, and the rows before a block's first stretch
    start are entered through them."""
    n, states = len(symbol), step.shape[1]
    same = np.arange(states)
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    moves = np.concatenate([step, same[None]])
    sym = np.concatenate([symbol, np.full(pad, len(step))]).reshape(blocks, BLOCK)
    new = np.concatenate([start, np.zeros(pad, bool)]).reshape(blocks, BLOCK)
    before = np.empty((blocks, BLOCK, states), np.int64)
    cur = np.tile(same, (blocks, 1))
    for j in range(BLOCK):
        cur[new[:, j]] = same
        before[:, j] = cur
        cur = np.take_along_axis(moves[sym[:, j]], cur, axis=1)
    # what a block makes of the state at its start; a stretch start inside cuts that off
    whole, cut = cur, new.any(axis=1)
    reach = 1
    while reach < blocks:
        joined = np.take_along_axis(whole[reach:], whole[:-reach], axis=1)
        joined = np.where(cut[reach:, None], whole[reach:], joined)
        whole, cut = np.concatenate([whole[:reach], joined]), np.concatenate([cut[:reach], cut[reach:] | cut[:-reach]])
        reach *= 2
    into = np.concatenate([entry[None], np.where(cut[:-1, None], whole[:-1], np.take_along_axis(whole[:-1], np.tile(entry, (blocks - 1, 1)), axis=1))])
    open_ = np.cumsum(new, axis=1) == 0
    entered = np.take_along_axis(before, into[:, None, :].repeat(BLOCK, axis=1), axis=2)
    before = np.where(open_[:, :, None], entered, before).reshape(-1, states)[:n]
    return before, np.take_along_axis(step[symbol], before, axis=1)


def run_state_machine(df: DataFrame, key: str, ts: str, symbol: str, transitions: list[tuple[str, str, str]],
                      initial: str, accept: str, reset: str, carry: list[str],
                      tiebreak: str | None = None, slot: str | int = DEFAULT_SLOT,
                      target_rows: int = DEFAULT_TARGET_ROWS, partitions: int | None = None) -> DataFrame:
    """O-80: explicit state machine per key.

    ``transitions`` = (state, symbol, next).  A symbol with no transition from
    the current state sends the key back to ``initial``; reaching ``reset``
    does the same; reaching ``accept`` emits the row (an alert) and the key
    stays in the state it was in.  Output: key + carried columns of alert rows."""
    states = sorted({initial} | {s for s, _, _ in transitions} |
                    {n for _, _, n in transitions if n not in (accept, reset)})
    idx = {s: i for i, s in enumerate(states)}
    n_states = len(states)
    init_i = idx[initial]
    # per symbol: next stable state and emit flag for each current state
    step: dict[str, tuple[list[int], list[bool]]] = {}
    for sym in {a for _, a, _ in transitions}:
        nxt, emit = [], []
        for s in states:
            t = dict(((st, a), n) for st, a, n in transitions).get((s, sym), initial)
            emit.append(t == accept)
            nxt.append(idx[s] if t == accept else (init_i if t in (reset, initial) else idx[t]))
        step[sym] = (nxt, emit)
    reset_all = ([init_i] * n_states, [False] * n_states)

    order = [ts] + ([tiebreak] if tiebreak else [])
    cols = list(dict.fromkeys([symbol, ts] + carry + ([tiebreak] if tiebreak else [])))
    d = with_split(df.select(_as_text(key).alias("_k"), *cols), ["_k"], ts, slot, target_rows).drop("_last", "_base")
    d = d.repartition(partitions, "_k", "_bkt") if partitions else d.repartition("_k", "_bkt")
    d = d.sortWithinPartitions("_k", "_bkt", *order)
    # carried values pass through Python as one string each, so they come back unchanged
    d = d.select("_k", "_bkt", F.col(symbol).cast("string").alias("_sym"),
                 F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(carry)])).alias("_carry"))
    out_schema = "kind string, k string, _bkt long, fn array<int>, flags array<boolean>, carried string"
    names = list(step)
    moves = np.array([step[a][0] for a in names] + [reset_all[0]])
    alerts_at = np.array([step[a][1] for a in names] + [reset_all[1]])
    known = pa.array(names, pa.string())

    def flat(rows: np.ndarray, kind) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * n_states), pa.array(rows.ravel(), kind))

    def told(kind: str, k: pa.Array, bkt: pa.Array, fn=None, flags=None, carried=None) -> pa.RecordBatch:
        n = len(k)
        return pa.RecordBatch.from_arrays([
            pa.array([kind] * n), k, bkt, pa.nulls(n, pa.list_(pa.int32())) if fn is None else flat(fn, pa.int32()),
            pa.nulls(n, pa.list_(pa.bool_())) if flags is None else flat(flags, pa.bool_()), pa.nulls(n, pa.string()) if carried is None else carried],
            names=["kind", "k", "_bkt", "fn", "flags", "carried"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, entry = None, np.arange(n_states)  # the stretch that is open, as (key, bucket) columns, and its function so far
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            k, bkt = b.column("_k"), b.column("_bkt")
            begin = np.zeros(n, bool)
            begin[_starts(b, ["_k", "_bkt"])] = True
            if last is not None and (last[0][0], last[1][0]) != (k[0], bkt[0]):
                yield told("bucket", *last, fn=entry[None])
                entry = np.arange(n_states)
            sym = pc.fill_null(pc.index_in(b.column("_sym"), known), len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
            before, after = prefix_states(sym, begin, moves, entry)
            flags = np.take_along_axis(alerts_at[sym], before, axis=1)
            if len(rows := np.flatnonzero(flags.any(axis=1))):
                at = pa.array(rows)
                yield told("alert", k.take(at), bkt.take(at), flags=flags[rows], carried=b.column("_carry").take(at))
            if len(ends := np.flatnonzero(begin[1:])):
                at = pa.array(ends)
                yield told("bucket", k.take(at), bkt.take(at), fn=after[ends])
            last, entry = (k.slice(n - 1), bkt.slice(n - 1)), after[-1]
        if last is not None:
            yield told("bucket", *last, fn=entry[None])

    from tideline.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    res = d.mapInArrow(run, out_schema).checkpoint()
    # entry state of every bucket: fold the composed functions of earlier buckets of the key
    fns = res.where(F.col("kind") == "bucket").groupBy("k").agg(
        F.array_sort(F.collect_list(F.struct("_bkt", "fn"))).alias("_fs"))
    entry = fns.select("k", F.aggregate(
        "_fs", F.struct(F.lit(init_i).alias("s"), F.array().cast("array<struct<_bkt:bigint,s:int>>").alias("out")),
        lambda acc, x: F.struct(F.element_at(x["fn"], acc["s"] + 1).alias("s"),
                                F.array_append(acc["out"], F.struct(x["_bkt"].alias("_bkt"), acc["s"].alias("s")))
                                .alias("out")))["out"].alias("_e"))
    entry = entry.select("k", F.explode("_e").alias("_x")).select("k", F.col("_x._bkt").alias("_bkt"),
                                                                   F.col("_x.s").alias("_entry"))
    alerts = res.where(F.col("kind") == "alert").join(entry, on=["k", "_bkt"], how="inner")
    alerts = alerts.where(F.element_at("flags", F.col("_entry") + 1))
    values = F.from_json("carried", ", ".join(f"c{i} string" for i in range(len(carry))))
    alerts = alerts.select("k", values.alias("_c"))
    return alerts.select(_as_key("k", df.schema[key].dataType).alias(key),
                         *[F.col(f"_c.c{i}").cast(df.schema[c].dataType).alias(c) for i, c in enumerate(carry)])
