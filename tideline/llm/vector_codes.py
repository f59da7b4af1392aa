"""Product codes of vectors, trained by rounds of nearest-entry assignment.

Components become integers floor(256 x); a vector is cut into ``PARTS`` equal parts, and
each part position has a codebook of ``ENTRIES`` entries: first that part of the vectors
with the smallest ids, then, after each round, the componentwise floor of the mean of the
parts assigned to the entry (unused entries stay).  A last assignment gives the codes.

Method: norm-of-sum bounds
1. The first assignment computes all distances.  Of each part it keeps the entry and, for
   each of ``GROUPS`` groups of entries, the smallest distance to one that isn't assigned,
   stamped with the round in which it was measured.
2. The codebooks of all rounds are kept.  In a later round an entry has moved from the
   stamped codebook by the norm of the sum of its moves, the true net displacement; the sum of
   the norms, which drifting bounds accumulate, is never smaller and mostly larger.  So
   (distance at the stamp) - (largest net displacement in the group) bounds the
   group's distances from below.
3. The distance to the assigned entry is computed exactly.  Only groups whose bound doesn't
   lie above it are scanned exactly; their bounds get the new stamp.  Bounds are 32-bit floats
   rounded down, the displacements are rounded up, and equal bounds are scanned, so the result is that of
   a full scan, ties (to the lower index) included.

Scale: an assignment is one pass without a shuffle; it writes vectors, entries and bounds for
the next.  A task sums its parts by entry and emits at most PARTS * ENTRIES sums.  Codebooks are
tables of fixed size (PARTS * ENTRIES entries a round) and go to the tasks.

Edge cases: vectors that are null or hold null, NaN or infinite components are left out, as are
those whose length differs from that of the smallest kept id's or isn't a positive multiple of
PARTS.  Integers beyond +-2^28 become +-2^28.  Rows of equal id are ordered by their components for the
first codebook; null ids come last.  Fewer vectors than ENTRIES give as many entries.
Repeated rows are vectors of their own; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.llm.common import drop_table, materialise
from tideline.sources.tables import read_table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Groups of entries that share a bound.
GROUPS = 4
SCALE = 256
LIMIT = 1 << 28
#: Vectors handled at once inside a task.
ROWS = 4096


@dataclass(frozen=True)
class Codebooks:
    """All rounds' entries: (round, part, entry, component), long integers."""

    history: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.history[-1].ravel().tolist())).encode()).hexdigest()

    def then(self, entries: np.ndarray) -> Codebooks:
        return Codebooks(np.concatenate([self.history, entries[None]]))


def integers(vector: str) -> Column:
    """The vector's components as integers; null for vectors that are left out."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    floor = F.transform(x, lambda c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), c)) * SCALE))).cast("int"))
    return F.when(fine, floor)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(rows, entries) squared distances of integer parts and entries."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - entries[None, :, i]) ** 2
    return out


def _groups(entries: int, groups: int) -> np.ndarray:
    return np.arange(entries) * groups // max(1, entries)


def _floored(squares: np.ndarray) -> np.ndarray:
    """Square roots as 32-bit floats that aren't too large."""
    root = np.sqrt(squares.astype(np.float64)).astype(np.float32)
    return np.nextafter(np.nextafter(root, np.float32(-1)), np.float32(-1))


def _lows(squares: np.ndarray, code: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """(rows, groups): bound of the distances to entries that aren't assigned; infinite without any."""
    others = squares.copy()
    others[np.arange(len(code)), code] = np.iinfo(np.int64).max
    low = np.full((len(code), groups), np.inf, np.float32)
    for g in range(groups):
        if (own := others[:, group == g]).shape[1]:
            least = own.min(axis=1)
            low[:, g] = np.where(least == np.iinfo(np.int64).max, np.float32(np.inf), _floored(least))
    return low


def net_displacements(history: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """(round, part, group): most that an entry of the group has moved since the round, rounded up."""
    moved = np.sqrt(((history[-1][None] - history).astype(np.float64) ** 2).sum(axis=3)) * (1 + 1e-12)
    return np.stack([moved[:, :, group == g].max(axis=2, initial=0) for g in range(groups)], axis=2)


def assign(x: np.ndarray, books: Codebooks, code=None, low=None, stamp=None, groups: int = GROUPS):
    """(code, low, stamp, squared error, parts rescanned) of vectors (rows, parts, components) for the newest
    codebooks, from the state that the round before has left (None: the first)."""
    now, entries = len(books.history) - 1, books.history[-1]
    n, parts = x.shape[:2]
    group = _groups(entries.shape[1], groups)
    error = np.zeros((n, parts), np.int64)
    if code is None:
        code, low = np.zeros((n, parts), np.uint8), np.zeros((n, parts, groups), np.float32)
        stamp = np.zeros((n, parts, groups), np.uint8)
        for p in range(parts):
            squares = _squares(x[:, p], entries[p])
            code[:, p] = squares.argmin(axis=1)
            error[:, p] = squares[np.arange(n), code[:, p]]
            low[:, p] = _lows(squares, code[:, p], group, groups)
        return code, low, stamp, error.sum(axis=1), n * parts
    code, low, stamp, scanned = code.copy(), low.copy(), stamp.copy(), 0
    moved = net_displacements(books.history, group, groups)
    for p in range(parts):
        error[:, p] = ((x[:, p] - entries[p, code[:, p]]) ** 2).sum(axis=1)
        own = np.sqrt(error[:, p].astype(np.float64)) * (1 + 1e-12)
        bound = low[:, p].astype(np.float64) - moved[stamp[:, p], p, np.arange(groups)]
        near = bound <= own[:, None]
        rows = np.flatnonzero(near.any(axis=1))
        scanned += len(rows)
        if not len(rows):
            continue
        squares = np.full((len(rows), entries.shape[1]), np.iinfo(np.int64).max)
        for g in range(groups):
            some = near[rows, g]
            squares[np.ix_(some, group == g)] = _squares(x[rows[some], p], entries[p, group == g])
        before = code[rows, p]
        squares[np.arange(len(rows)), before] = error[rows, p]
        best = squares.argmin(axis=1)
        error[rows, p] = squares[np.arange(len(rows)), best]
        fresh = _lows(squares, best, group, groups)
        for g in range(groups):
            some = near[rows, g]
            low[rows[some], p, g], stamp[rows[some], p, g] = fresh[some, g], now
        # the entry that was given up is no longer left out of its group's bound
        gone = np.flatnonzero(best != before)
        g = group[before[gone]]
        to = rows[gone]
        held = low[to, p, g].astype(np.float64) - moved[stamp[to, p, g], p, g]
        low[to, p, g] = np.minimum(held.astype(np.float32), _floored(squares[gone, before[gone]]))
        low[to, p, g] = np.nextafter(low[to, p, g], np.float32(-np.inf))
        stamp[to, p, g] = now
        code[rows, p] = best
    return code, low, stamp, error.sum(axis=1), scanned


def _ints(column: pa.Array, rows: int, kind) -> np.ndarray:
    """A binary column of equally long values as an array (rows, values)."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(rows, -1)


def _bytes(a: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in a], pa.binary())


_STATE = "id {id}, label {label}, x binary, code binary, low binary, stamp binary, error long"


def _pass(df: DataFrame, books: Codebooks, parts: int, groups: int, schema: str) -> DataFrame:
    """The state after an assignment; without a column ``code`` the vectors (arrays of integers) are new."""
    old = "code" in df.columns

    def task(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n = batch.num_rows
                if old:
                    flat = _ints(batch.column("x"), n, np.int32)
                    state = (_ints(batch.column("code"), n, np.uint8), _ints(batch.column("low"), n, np.float32).reshape(n, parts, groups),
                             _ints(batch.column("stamp"), n, np.uint8).reshape(n, parts, groups))
                else:
                    flat, state = batch.column("x").flatten().to_numpy().reshape(n, -1).astype(np.int32), ()
                code, low, stamp, error, _ = assign(flat.reshape(n, parts, -1).astype(np.int64), books, *state, groups=groups)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), _bytes(flat), _bytes(code), _bytes(low), _bytes(stamp), pa.array(error)],
                    names=["id", "label", "x", "code", "low", "stamp", "error"])

    return df.mapInArrow(task, schema)


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after a round: a task sums its parts by (part, entry), the driver gets one row for each."""
    parts, entries, size = books.history.shape[1:]

    def task(batches):
        total, count = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            n = batch.num_rows
            if n:
                x = _ints(batch.column("x"), n, np.int32).reshape(n * parts, size)
                slot = (_ints(batch.column("code"), n, np.uint8) + np.arange(parts) * entries).ravel()
                count += np.bincount(slot, minlength=parts * entries)
                for i in range(size):
                    # halves keep the float sums exact
                    high, rest = x[:, i] >> 14, x[:, i] & 0x3FFF
                    total[:, i] += (np.bincount(slot, high, parts * entries).astype(np.int64) << 14) + np.bincount(slot, rest, parts * entries).astype(np.int64)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), *(pa.array(total[used, i]) for i in range(size))],
                                         names=["slot", "n", *(f"s{i}" for i in range(size))])

    sums = state.select("x", "code").mapInArrow(task, "slot int, n long, " + ", ".join(f"s{i} long" for i in range(size)))
    rows = sums.groupBy("slot").agg(F.sum("n"), *(F.sum(f"s{i}") for i in range(size))).collect()
    new = books.history[-1].copy().reshape(parts * entries, size)
    for slot, n, *s in rows:
        new[slot] = [v // n for v in s]
    return books.then(new.reshape(parts, entries, size))


@dataclass(frozen=True)
class Codes:
    """``rows``: (id, label, code, error), code one byte a part; the trained codebooks."""

    rows: DataFrame
    books: Codebooks


def train_and_encode(vectors: DataFrame, vec_id: str, vector: str, label: str | None = None, parts: int = PARTS,
                     entries: int = ENTRIES, rounds: int = ROUNDS, groups: int = GROUPS) -> Codes | None:
    """Codebooks of ``rounds`` rounds and the codes of all kept vectors; None if none is kept."""
    kind = {c: vectors.schema[c].dataType.simpleString() for c in (vec_id, label) if c}
    schema = _STATE.format(id=kind[vec_id], label=kind[label] if label else "int")
    kept = (vectors.select(F.col(vec_id).alias("id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"), integers(vector).alias("x"))
            .filter((F.size("x") > 0) & (F.size("x") % parts == 0)))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).select(F.size("x")).first()
    if first is None:
        return None
    kept = kept.filter(F.size("x") == first[0])
    start = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    x = np.array([r.x for r in start], np.int64).reshape(len(start), parts, -1)
    books = Codebooks(np.ascontiguousarray(x.transpose(1, 0, 2))[None])
    state = _pass(kept, books, parts, groups, schema)
    for _ in range(rounds):
        table = materialise(state, "vector-state")
        books = _updated(table, books)
        after = materialise(_pass(table, books, parts, groups, schema), "vector-state")
        drop_table(table)
        state = after
    return Codes(state.select("id", "label", "code", "error"), books)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors of ``embeddings``."""
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    got = train_and_encode(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    if got is None:
        return spark.createDataFrame([], schema)
    by_label = materialise(got.rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    rows = got.rows.join(by_label.withColumnRenamed("label", "__l"), F.col("label").eqNullSafe(F.col("__l")))
    return rows.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(got.books.digest()).alias("codebooks_sha256"))


def _sql() -> str:
    """Both rounds and the last assignment, written out round by round."""
    def nearest(book: str, of: str) -> str:
        return (f"SELECT row, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (SELECT v.row, v.p, c.e, "
                f"list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS d "
                f"FROM {of} v JOIN {book} c USING (p)) GROUP BY row, p")

    steps = []
    for r in range(ROUNDS):
        steps += [f"a{r} AS MATERIALIZED ({nearest(f'c{r}', 'v')})",
                  f"m{r} AS (SELECT p, e, i, CAST(floor(CAST(sum(x) AS HUGEINT) / count(*)) AS BIGINT) AS x FROM "
                  f"(SELECT v.p, a.e, unnest(range(1, len(v.x) + 1)) AS i, unnest(v.x) AS x FROM v JOIN a{r} a USING (row, p)) GROUP BY ALL)",
                  f"n{r} AS (SELECT p, e, list(x ORDER BY i) AS x FROM m{r} GROUP BY p, e)",
                  f"c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(n.x, c.x) AS x FROM c{r} c LEFT JOIN n{r} n USING (p, e))"]
    return f"""
WITH k AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, x) - 1 AS row, x FROM (
    SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
v AS MATERIALIZED (SELECT row, p, x[p * (len(x) // {PARTS}) + 1:(p + 1) * (len(x) // {PARTS})] AS x FROM k, range({PARTS}) r(p)),
c0 AS (SELECT p, row AS e, x FROM v WHERE row < {ENTRIES}),
{', '.join(steps)},
last AS MATERIALIZED ({nearest(f'c{ROUNDS}', 'v')}),
o AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM c{ROUNDS}) AS codebooks_sha256
FROM k JOIN o USING (row)
"""


ORACLE_SQL = _sql()
