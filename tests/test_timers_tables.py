"""Moved timers, expiring entries, upserted windows, stamped arrivals; table functions, reduce, sliding count windows."""

import os
import random
import time

import pytest
from conftest import frame
from pyspark.sql import functions as F
from streams import run_to_memory, stream_parts
from tideline.operators import aggs, table_functions
from tideline.streaming import ops, sinks, timers
from tideline.streaming.replay import read_replay, run_to_parquet


def batches(spark, parts, schema, scratch, name):
    folders = []
    for i, rows in enumerate(parts):
        folders.append(os.path.join(scratch, f"{name}-{i}"))
        frame(spark, rows, schema).coalesce(1).write.parquet(folders[-1])
    return stream_parts(spark, folders, frame(spark, parts[0], schema).schema, os.path.join(scratch, name))


def told(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def bursts(rows, quiet, end):
    """Brute force: a row starts a burst if no row of its key came less than ``quiet`` before."""
    out = []
    for key in {k for k, m in rows}:
        last = None
        for m in sorted(m for k, m in rows if k == key and m is not None):
            if last is None or m - last >= quiet:
                out.append([key, m, m + quiet, 1])
            else:
                out[-1][2:] = [m + quiet, out[-1][3] + 1]
            last = m
    return sorted((tuple(b) for b in out if b[2] <= end), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_debounce_moves_timers(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), 1000 * rng.randint(1, 200)) for _ in range(120)]
    rows.sort(key=lambda r: r[1] + rng.randint(-9000, 9000))  # at most 18 s late
    rows[10:10] = [("a", None)]
    parts = [rows[i:i + 30] for i in range(0, 121, 30)] + [[("z", 500_000)], [("z", 500_001)]]
    s = batches(spark, parts, "k string, ms long", scratch, "debounce")
    out = run_to_memory(timers.debounce_stream(s, "k", "ts", "3 seconds", delay="20 seconds"), "append", os.path.join(scratch, "ck"))
    want = bursts(rows, 3000, 480_000)
    assert told(out, "k", "first_ms", "fire_ms", "cnt") == want
    assert any(b[3] > 2 for b in want) and any(b[3] == 1 for b in want)


@pytest.mark.parametrize("ttl,refresh,again", [("2 hours", False, True), ("2 hours", True, True), ("1 millisecond", False, False)])
def test_entries_expire_one_by_one(spark, scratch, ttl, refresh, again):
    schema = "k string, ms long, id long, item string"
    parts = [[("a", 1, 1, "x"), ("a", 2, 2, "x"), (None, 3, 3, None)], [("a", 4, 4, "x"), ("a", 5, 5, "y"), (None, 6, 6, None), (None, 7, 7, "")]]
    landing, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    for i, rows in enumerate(parts):
        frame(spark, rows, schema).coalesce(1).write.mode("append").parquet(landing)
        s = read_replay(spark, landing, frame(spark, rows, schema).schema)
        run_to_parquet(timers.recently_seen_stream(s, "k", "ts", "item", "id", ttl, refresh), out, os.path.join(scratch, "ck"), empty_batches=False)
        time.sleep(0.2)
    first = [(1, 1, 1), (2, 1, 2), (3, 3, 1)]
    later = [(4, 1, 3), (5, 5, 4), (6, 3, 2), (7, 7, 3)] if again else [(4, 4, 1), (5, 5, 2), (6, 6, 1), (7, 7, 2)]
    assert told(spark.read.parquet(out), "tb", "first_id", "recent_rows") == first + later
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_upserts_take_late_rows_within_the_lateness(spark, scratch):
    parts = [[("a", 1000), ("a", 12_000), (None, 2000)], [("a", 3000), ("a", 25_000)], [("a", 40_000)], [("a", 41_000)],
             [("a", 4000), ("a", 31_000), (None, 42_000)]]
    s = batches(spark, parts, "k string, ms long", scratch, "late")
    counts = ops.window_count_with_lateness(s, "k", "ts", "10 seconds", "0 seconds", "20 seconds")
    out = os.path.join(scratch, "upserts")
    sinks.upsert_sink(counts, out, os.path.join(scratch, "ck")).awaitTermination()
    table = spark.read.parquet(out)
    got = told(sinks.latest_rows(table, ["k", "window_start"]).select("k", F.col("window_start").cast("string").alias("w"), "cnt"))
    # the row of 3 s updates its window, that of 4 s comes when the watermark (20 s) has passed its window
    assert [(k, w[-2:], n) for k, w, n in got] == [("a", "00", 2), ("a", "10", 1), ("a", "20", 1), ("a", "30", 1), ("a", "40", 2), (None, "00", 1), (None, "40", 1)]
    assert table.where("k = 'a'").groupBy("window_start").count().agg(F.max("count")).first()[0] > 1


def test_stamps_are_kept(spark, scratch):
    s = batches(spark, [[("a", 1000)], [(None, None)]], "k string, ms long", scratch, "stamps")
    out = os.path.join(scratch, "stamped")
    sinks.stamped_sink(s, out, os.path.join(scratch, "ck")).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 2 and rows.where("arrived IS NULL").count() == 0
    assert rows.select("arrived").distinct().count() == 2  # one per micro-batch


def test_table_functions(spark):
    df = frame(spark, [("a", 1, "x y"), ("a", 2, None), (None, 3, ""), (None, 4, "z"), ("b", None, "w")], "k string, ms long, text string").withColumn("n", F.col("ms"))
    words = table_functions.flat_map_function(df, lambda text: ((w, len(w)) for w in (text or "").split()), ["text"], "word string, size int", ["k", "text"])
    assert told(words) == sorted([("a", "x y", "x", 1), ("a", "x y", "y", 1), (None, "z", "z", 1), ("b", "w", "w", 1)], key=str)

    def step(seen, row):
        seen.append(row["n"])
        yield len(seen), row["n"]
    keyed = table_functions.keyed_table_function(df, ["k"], ["n"], ["n"], list, step, lambda seen: [(-1, len(seen))], "i int, n long")
    assert told(keyed) == sorted([("a", 1, 1), ("a", 2, 2), ("a", -1, 2), (None, 1, 3), (None, 2, 4), (None, -1, 2), ("b", 1, None), ("b", -1, 1)], key=str)
    none = df.where("k = 'missing'")
    assert table_functions.keyed_table_function(none, ["k"], ["n"], ["n"], list, step, lambda seen: [(-1, len(seen))], "i int, n long").count() == 0
    assert table_functions.flat_map_function(none, lambda text: [(text,)], ["text"], "word string", ["k"]).count() == 0


def test_table_functions_build_no_batch_per_call(spark):
    df = frame(spark, [("a", 1, 2), ("a", 2, 3), (None, 3, None)], "k string, ms long, n long")

    def step(state, row):
        yield row["n"], row["n"], None if row["n"] is None else [row["n"], None], row["k"]
    schema = "d double, m decimal(9,2), parts array<double>, s string"
    keyed = table_functions.keyed_table_function(df, ["k"], ["ms"], ["n"], list, step, lambda state: [], schema)
    flat = table_functions.flat_map_function(df, lambda n: [(n, n, None if n is None else [n, None], n)], ["n"], schema, ["k"])
    for out in (keyed, flat):
        assert "ArrowEvalPythonUDTF" not in out._jdf.queryExecution().toString()
        assert [(r.k, r.d, r.m, r.parts) for r in out.orderBy("d").collect()] == [(None, None, None, None), ("a", 2.0, 2, [2.0, None]), ("a", 3.0, 3, [3.0, None])]
    assert [r.s for r in keyed.orderBy("d").collect()] == [None, "a", "a"] and [r.s for r in flat.orderBy("d").collect()] == [None, "2", "3"]
    with pytest.raises(Exception, match="is no int"):
        table_functions.flat_map_function(df, lambda n: [(2**40,)], ["n"], "i int", ["k"]).collect()


def test_reduce_in_parts(spark):
    rows = [(random.Random(i).choice(["a", "b", None]), i * 37 % 101, None if i % 10 == 0 else i) for i in range(200)]
    df = frame(spark, rows, "k string, ms long, v long").repartition(7)

    def fold(a, b):
        return max(a[0], b[0]), (a[1] or 0) + (b[1] or 0)
    got = {r["k"]: (r["ms"], r["v"]) for r in table_functions.reduce_function(df, ["k"], ["ms", "v"], fold).collect()}
    assert got == {k: (max(m for q, m, v in rows if q == k), sum(v or 0 for q, m, v in rows if q == k)) for k in ("a", "b", None)}


@pytest.mark.parametrize("size,step,target", [(5, 2, 1), (5, 2, 3), (3, 7, 2), (1, 1, 2), (10, 3, 4), (4, 4, 1000)])
def test_sliding_count_windows_over_small_buckets(spark, size, step, target):
    rng = random.Random(size * 100 + step)
    rows = [(rng.choice(["a", None]), 1000 * rng.randint(1, 25), i, rng.choice([None, float(rng.randint(0, 9))])) for i in range(60)]
    df = frame(spark, rows, "k string, ms long, id long, v double")
    got = aggs.count_window_sliding(df, "k", "ts", size, step, "v", tiebreak="id", slot="1 second", target_rows=target)
    want = []
    for key in ("a", None):
        values = [r[3] for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))]
        for n in range(step, len(values) + 1, step):
            last = values[max(0, n - size):n]
            known = [v for v in last if v is not None]
            want.append((key, n, len(last), sum(known) if known else None))
    assert told(got, "k", "fire_seq", "cnt", "total") == sorted(want, key=str)
