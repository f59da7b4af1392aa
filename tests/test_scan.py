"""Sequential folds: numpy parts against plain loops, and keys far above a bucket."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tideline.functions.time import ntz_from_us
from tideline.operators import scan


def chain(t, interval):
    """(fire, rows up to it) of sorted times, by a plain loop."""
    out, i = [], 0
    while i < len(t):
        fire = t[i] + interval
        i = int(np.searchsorted(t, fire, "right"))
        out.append((fire, i))
    return out


def states_by_loop(symbol, start, step, entry):
    cur, before, after = list(entry), [], []
    for s, new in zip(symbol, start):
        cur = list(range(len(cur))) if new else cur
        before.append(cur)
        cur = [int(step[s][c]) for c in cur]
        after.append(cur)
    return np.array(before), np.array(after)


@pytest.mark.parametrize("n,states,rate", [(1, 3, 0), (64, 2, 0.1), (65, 4, 0), (1000, 5, 0.01), (4097, 3, 0.3)])
def test_prefix_states(n, states, rate):
    rng = np.random.default_rng(n)
    step = rng.integers(0, states, (6, states))
    symbol, start, entry = rng.integers(0, 6, n), rng.random(n) < rate, rng.integers(0, states, states)
    got, want = scan.prefix_states(symbol, start, step, entry), states_by_loop(symbol, start, step, entry)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_prefix_states_is_faster_than_a_loop():
    rng = np.random.default_rng(1)
    step = rng.integers(0, 4, (5, 4))
    symbol, start, entry = rng.integers(0, 5, 50_000), rng.random(50_000) < 0.001, np.arange(4)
    scan.prefix_states(symbol, start, step, entry)
    took = []
    for f in (scan.prefix_states, states_by_loop):
        t = time.perf_counter()
        f(symbol, start, step, entry)
        took.append(time.perf_counter() - t)
    assert took[0] * 3 < took[1]


def test_jumps():
    rng = np.random.default_rng(2)
    for gap, interval in ((1, 500), (1000, 10), (1000, 5000), (1000, 10**9)):
        t = np.unique(rng.integers(0, 800 * gap, 1000))
        after = scan.next_anchors(t, interval)
        last = scan.last_anchors(after)
        for i in range(0, len(t), 37):
            j = i
            while after[j] < len(t):
                j = int(after[j])
            assert last[i] == j


def test_a_million_rows_of_a_key_in_a_day(spark):
    us = F.floor(F.rand(3) * 86_400_000_000).cast("long")
    df = spark.range(1_000_000).select(F.lit("hot").alias("k"), us.alias("us")).union(
        spark.range(50).select(F.lit("cold"), F.col("id") * 3_600_000_000))
    df = df.checkpoint()
    got = scan.periodic_count(df.withColumn("ts", ntz_from_us("us")), "k", "ts", "37 minutes", target_rows=20_000).collect()
    t = {k: np.sort(np.array([r.us for r in df.where(F.col("k") == k).collect()])) for k in ("hot", "cold")}
    assert sorted((r.k, r.fire_us, r.cnt) for r in got) == sorted((k, int(f), n) for k, x in t.items() for f, n in chain(x, 37 * 60_000_000))
