"""Streams whose keys are dealt to groups: state and timers don't grow with the keys."""

import os
import random

import pandas as pd
import pytest
from conftest import frame
from pyspark.sql import functions as F
from streams import run_to_memory, stream_parts
from tideline.streaming import feeds, stateful, timers


def two_feeds(s, groups, delay="0 seconds"):
    sides = [s.where(F.col("id") % 2 == i) for i in (0, 1)]
    return feeds.two_feeds_stream(*sides, "k", "ts", "id", "5 minutes", delay, groups)


OPERATORS = {
    "two_feeds": two_feeds,
    "debounce": lambda s, n: timers.debounce_stream(s, "k", "ts", "5 minutes", groups=n),
    "timers": lambda s, n: stateful.event_time_timers(s, "k", "ts", "5 minutes", groups=n),
    "keep_last": lambda s, n: stateful.keep_last_stream(s.withColumn("v", F.col("id") / 2), "k", "ts", "v", "id", "5 minutes", 2, groups=n),
    "followed_by": lambda s, n: stateful.followed_by_stream(s, "k", "ts", F.col("id") >= 0, F.col("id") < 0, "5 minutes", "id", groups=n),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_state_is_per_group(spark, scratch, name):
    rows = frame(spark, [(2**60 + i, 1 + i % 7, i) for i in range(4000)], "k long, ms long, id long")
    folder = os.path.join(scratch, "rows")
    rows.coalesce(1).write.parquet(folder)
    s = stream_parts(spark, [folder], rows.schema, os.path.join(scratch, "in"))
    q = (OPERATORS[name](s, 8).writeStream.format("noop").outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    # open rows, a timer and its index entry for each group
    assert 0 < max(held) <= 3 * 8


def test_many_rows_per_key_are_held_per_group(spark, scratch):
    """Both feeds have many rows of a key, some of them late: pairs over micro-batches, and state that doesn't grow with the keys."""
    rng, n = random.Random(7), 3000
    rows = [(i // 2 % 500, 60_000 + 20 * i + rng.randint(0, 5000), i) for i in range(n)]
    folders = []
    for i, part in enumerate((rows[:n // 2], rows[n // 2:])):
        folders.append(os.path.join(scratch, str(i)))
        df = frame(spark, part, "k long, ms long, id long")
        df.coalesce(1).write.parquet(folders[-1])
    s = stream_parts(spark, folders, df.schema, os.path.join(scratch, "in"))
    out, name = two_feeds(s, 8, "30 seconds"), "many_rows_per_key"
    q = (out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", os.path.join(scratch, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 3 * 8
    want = {(a[2], b[2]) for a in rows[::2] for b in rows[1::2] if a[0] == b[0] and abs(a[1] - b[1]) <= 300_000}
    assert len(want) > n
    assert {(r.l_id, r.r_id) for r in spark.table(name).where("status = 'matched'").collect()} == want


def test_pairs_told_in_parts(monkeypatch):
    monkeypatch.setattr(feeds, "MAX_PAIRS", 3)
    rng = random.Random(5)
    rows = pd.DataFrame([(rng.choice(["0", "1a", "1b"]), rng.random() < 0.5, rng.randint(0, 40), i, True, False) for i in range(80)],
                        columns=feeds.TwoFeeds.columns)
    for known in (0, 30, 80):
        out, rest, due = feeds.TwoFeeds(3).advance(rows, known, 20)
        got = pd.concat(list(out))
        pairs = {(a.id, b.id) for a in rows.itertuples() for b in rows.itertuples()
                 if a.is_left and not b.is_left and a.k == b.k != "0" and abs(a.ms - b.ms) <= 3 and max(a.id, b.id) >= known}
        found = got[got["status"] == "matched"]
        assert sorted(zip(found["l_id"], found["r_id"])) == sorted(pairs)
        paired = {i for p in pairs for i in p}
        assert set(rest["id"]) == {r.id for r in rows.itertuples() if r.ms + 4 > 20} and due == min(r.ms + 4 for r in rows.itertuples() if r.ms + 4 > 20)
        assert set(rest.loc[rest["paired"], "id"]) == paired & set(rest["id"])
        assert set(got.loc[got["status"] == "right_missing", "l_id"]) == {r.id for r in rows.itertuples() if r.is_left and r.ms + 4 <= 20} - paired
        assert set(got.loc[got["status"] == "left_missing", "r_id"]) == {r.id for r in rows.itertuples() if not r.is_left and r.ms + 4 <= 20} - paired


def followed_by(rows, within, now):
    """Brute force over (k, ms, id, start, end) rows: matches and timeouts of the starts that ``now`` has reached."""
    out = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k and r[1] <= now), key=lambda r: (r[1], r[2] is not None, r[2] or 0))
        for i, (_, ms, tb, start, _) in enumerate(mine):
            end = next((r for r in mine[i + 1:] if r[4]), None)
            if start and end and end[1] - ms < within:
                out.append((k, tb, end[2], "matched"))
            elif start and ms + within <= now:
                out.append((k, tb, None, "timeout"))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_followed_by_out_of_order(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]), 1000 * rng.randint(1, 99), rng.choice([None, *range(40)]), rng.random() < 0.4, rng.choice([None, True, False]))
            for _ in range(150)]
    rows = [(*r[:2], 1000 + i if r[2] is None and rng.random() < 0.8 else r[2] and 1000 + i, *r[3:]) for i, r in enumerate(rows)]
    rows.sort(key=lambda r: r[1] + rng.randint(-9000, 9000))  # at most 18 s late
    parts, folders, schema = [rows[i:i + 30] for i in range(0, 150, 30)] + [[("z", 110_000, 1, False, False)], [("z", 110_001, 1, False, False)]], [], None
    for i, part in enumerate(parts):
        folders.append(os.path.join(scratch, str(i)))
        df = frame(spark, part, "k string, ms long, id long, a boolean, b boolean")
        df.coalesce(1).write.parquet(folders[-1])
    s = stream_parts(spark, folders, df.schema, os.path.join(scratch, "in"))
    out = run_to_memory(stateful.followed_by_stream(s, "k", "ts", F.col("a"), F.col("b"), "5 seconds", "id", delay="20 seconds", groups=3),
                        "append", os.path.join(scratch, "ck"))
    got = sorted(((r.k, r.start_id, r.end_id, r.status) for r in out.collect()), key=str)
    assert got == followed_by(rows, 5000, 90_000)
    assert {r[3] for r in got} == {"matched", "timeout"}


def test_keep_last_of_many_windows():
    rng = random.Random(3)
    rows = pd.DataFrame([(rng.choice(["0", "1a", "1b"]), 0, rng.randint(0, 60), rng.randint(0, 5) if has else 0, has, float(rng.randint(0, 9)), rng.random() < 0.6)
                         for has in (rng.random() < 0.8 for _ in range(90))], columns=stateful.KeepLastWindow.columns)
    rows["w"] = rows["ms"] // 10 * 10
    out, rest, due = stateful.KeepLastWindow(10, 3).advance(rows, 0, 30)
    want, held = [], 0
    for (k, w), mine in rows.groupby(["k", "w"]):
        last = mine.sort_values(["ms", "has_tb", "tb"], kind="stable").tail(3)
        held += len(last) if w + 10 > 30 else 0
        want += [(k, w, len(last), last.loc[last["has_v"], "v"].sum(), last["has_v"].any())] if w + 10 <= 30 else []
    assert sorted(out[0].itertuples(index=False, name=None)) == sorted(want)
    assert len(rest) == held and due == 40
    again, rest, due = stateful.KeepLastWindow(10, 3).advance(rest[list(stateful.KeepLastWindow.columns)], len(rest), 100)
    assert again[0]["cnt"].sum() == held and not len(rest) and due is None
