"""Keyed state on streams: every row counts, whatever arrives together, and nulls end no stream."""

import os
import random

import pytest
from conftest import frame
from streams import run_to_memory, stream_parts
from pyspark.sql import functions as F
from tideline.streaming import feeds, stateful, topn


def batches(spark, parts, schema, scratch, name):
    """Each list of rows is a micro-batch."""
    folders = []
    for i, rows in enumerate(parts):
        folders.append(os.path.join(scratch, f"{name}-{i}"))
        frame(spark, rows, schema).coalesce(1).write.parquet(folders[-1])
    return stream_parts(spark, folders, frame(spark, parts[0], schema).schema, os.path.join(scratch, name))


def run(df, scratch, name):
    return run_to_memory(df, "append", os.path.join(scratch, name + "-ck"))


def told(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def pairs_and_misses(left, right, wait, end):
    out = [(k, i, j, "matched") for k, m, i in left for q, n, j in right if k is not None and k == q and abs(m - n) <= wait]
    out += [(k, i, None, "right_missing") for k, m, i in left if m + wait < end and not any(x[1] == i for x in out)]
    return out + [(k, None, j, "left_missing") for k, n, j in right if n + wait < end and not any(x[2] == j for x in out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_two_feeds_pair_all_rows(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randint(1, 60_000), 1000 * rng.randint(1, 60)]), i, rng.choice(["left", "right"])) for i in range(160)]
    rows.sort(key=lambda r: r[1] + rng.randint(-9000, 9000))  # at most 18 s late
    rows.append(("z", 200_000, 999, "left"))
    parts = [rows[i:i + 30] for i in range(0, 150, 30)] + [rows[150:160], rows[160:]]
    s = batches(spark, parts, "k string, ms long, id long, side string", scratch, "feeds")
    sides = [s.where(F.col("side") == x).drop("side") for x in ("left", "right")]
    got = run(feeds.two_feeds_stream(*sides, "k", "ts", "id", "2 seconds", delay="20 seconds"), scratch, "feeds")
    want = pairs_and_misses(*[[r[:3] for r in rows if r[3] == x] for x in ("left", "right")], 2000, 180_000)
    assert told(got, "k", "l_id", "r_id", "status") == sorted(want, key=str)
    assert sum(w[3] == "matched" for w in want) > 50


def test_one_row_meets_three(spark, scratch):
    rows = [("a", 1000, 1, "left"), ("a", 2000, 2, "left"), ("a", 2500, 3, "left"), ("a", 2600, 4, "right"), ("a", 9000, 5, "left"), (None, 9000, 6, "left")]
    s = batches(spark, [rows, [("a", 90_000, 7, "right"), ("a", None, 8, "left")], [("z", 91_000, 9, "right")]],
                "k string, ms long, id long, side string", scratch, "three")
    sides = [s.where(F.col("side") == x).drop("side") for x in ("left", "right")]
    got = run(feeds.two_feeds_stream(*sides, "k", "ts", "id", "3 seconds"), scratch, "three")
    assert told(got, "l_id", "r_id", "status") == [
        (1, 4, "matched"), (2, 4, "matched"), (3, 4, "matched"), (5, None, "right_missing"), (6, None, "right_missing")]


def test_top_n_state_is_bounded(spark, scratch):
    items = [(f"i{i % 100_000}", 1000 + i % 50_000) for i in range(100_000)] + [("i7", 2000)] * 3 + [("i99", 2000)] * 2 + [(None, 2000)] * 2
    parts = [items[:60_000], items[60_000:], [("end", 500_000)]]
    s = batches(spark, parts, "item string, ms long", scratch, "items")
    got = run(topn.candidates(s, "item", "ts", "60 seconds", None, 3, buckets=8), scratch, "held")
    assert got.count() == 3 * 8
    s = batches(spark, parts, "item string, ms long", scratch, "items2")
    out = run(topn.windowed_top_n(s, "item", "ts", "60 seconds", None, 3, buckets=8), scratch, "top")
    assert [(r["item"], r["cnt"], r["rn"]) for r in out.orderBy("rn").collect()] == [("i7", 4, 1), ("i99", 3, 2), (None, 2, 3)]


NULLS = [[("a", 1000, 1, 2.0), ("a", None, 2, None), ("a", 2000, None, 1.0), (None, 3000, 4, None)],
         [("a", 4000, 5, None), (None, None, None, None), ("a", 5000, 6, 3.0)], [("z", 100_000, 7, 1.0)], [("z", 100_001, 8, 1.0)]]


@pytest.mark.parametrize("name,build,want", [
    ("timers", lambda s: stateful.event_time_timers(s, "k", "ts", "1 second").select("k", "timer_ms"),
     [("a", 2000), ("a", 3000), ("a", 5000), ("a", 6000), (None, 4000)]),
    ("periodic", lambda s: stateful.periodic_count_stream(s, "k", "ts", "10 seconds").select("k", "fire_ms", "cnt"), [("a", 11000, 4), (None, 13000, 1)]),
    ("changelog", lambda s: stateful.changelog_stream(s, "k", "ts", "id").select("k", "op", "cnt").where("k = 'a' AND op <> '-U'"),
     [("a", "+I", 1), ("a", "+U", 2), ("a", "+U", 3), ("a", "+U", 4), ("a", "+U", 5)]),
    ("first", lambda s: stateful.first_n_average_stream(s, "k", "ts", "id", 2), [("a", 1500), ("z", 100_000)]),
    ("machine", lambda s: stateful.state_machine_stream(s, "k", "ts", "v", "id", [("S", "2.0", "T"), ("T", "1.0", "A")], "S", "A", "X").select("k", "tb"), []),
    ("within", lambda s: stateful.followed_by_stream(s, "k", "ts", F.col("v") > 1, F.col("v") < 2, "20 seconds", "id").select("k", "start_id", "status"),
     [("a", 1, "matched"), ("a", 6, "timeout")]),
    ("count", lambda s: stateful.count_window_stream(s, "k", "ts", "v", "id", 2).select("k", "cnt", "total"),
     [("a", 2, 3.0), ("a", 2, None), (None, 2, None), ("z", 2, 2.0)]),
    ("strict", lambda s: stateful.strict_sequence_stream(s, "k", "ts", "id", [F.col("v") == 1, F.col("v") == 2]).select("k", "ids"), [("a", [None, 1])]),
    ("previous", lambda s: stateful.rule_matches_stream(s, "k", "ts", "v", "id", s.sparkSession.createDataFrame([("1.0", "2.0")], "action1 string, action2 string"))
     .select("k", "tb"), [("a", 1)]),
    ("last", lambda s: stateful.keep_last_stream(s, "k", "ts", "v", "id", "10 seconds", 2).select("k", "cnt", "total"), [("a", 2, 3.0), (None, 1, None)]),
])
def test_null_rows(spark, scratch, name, build, want):
    s = batches(spark, NULLS, "k string, ms long, id long, v double", scratch, name)
    if name in ("machine", "previous"):
        s = s.withColumn("v", F.col("v").cast("string"))
    got = run(build(s), scratch, name)
    assert told(got) == sorted(want, key=str)
