"""Sessions with user aggregates against a plain loop, at several bucket sizes."""

import random

import pytest
from conftest import frame
from pyspark.sql import functions as F
from tideline.operators import windows
from tideline.operators.rows import MeanOf, RowsPerDistinct
from tideline.operators.sessions import session_aggregate


def brute(rows, gap):
    """(key, start, end, mean) by a loop over each key's rows in time order; gap(row) in ms."""
    out = []
    for k in {r[0] for r in rows}:
        cur = None
        for _, ms, v in sorted((r for r in rows if r[0] == k and r[1] is not None), key=lambda r: r[1]):
            if cur is None or ms > cur[1]:
                if cur:
                    out.append((k, *cur))
                cur = [ms, ms, []]
            cur[1] = max(cur[1], ms + gap(ms))
            cur[2].append(v)
        if cur:
            out.append((k, *cur))
    return sorted(((k, a, b, sum(x for x in v if x is not None) / n if (n := sum(x is not None for x in v)) else None) for k, a, b, v in out), key=str)


@pytest.mark.parametrize("target", [1, 7, 10**6])
def test_split_sessions(spark, target):
    rng = random.Random(target)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(1, 20)]) and rng.randint(1, 400) * 500, rng.choice([None, 1.0, 2.0, 8.0])) for _ in range(300)]
    df = frame(spark, rows, "k string, ms long, v double").repartition(5)
    for gap, ms in (("2 seconds", lambda t: 2000), (F.col("ms") % 7 * 300_000, lambda t: t % 7 * 300)):
        out = session_aggregate(df, "k", "ts", gap, ["v"], MeanOf("v"), "double", "mean", slot="1 second", target_rows=target)
        out = out.select("k", *(F.unix_millis(F.col(c).cast("timestamp")).alias(c) for c in ("session_start", "session_end")), "mean")
        assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows, ms)


def test_varying_gaps_cost_no_call_per_session(spark):
    """Each row is a session of its own or joins the next one's by its own gap; none costs a call between Spark and Python."""
    rows = [(i % 40, 10_000 * (i // 40), float(i), 10_001 if i // 40 % 3 else 1) for i in range(2400)]
    df = frame(spark, rows, "k long, ms long, v double, gap long").repartition(3)
    out = session_aggregate(df, "k", "ts", F.col("gap") * 1000, ["v"], RowsPerDistinct("v"), "double", "per", slot="1 second", target_rows=5)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
    # of a key's rows, ten seconds apart, the first is a session of its own; then three at a time reach each other
    assert sorted((r.k, (r.session_end - r.session_start).total_seconds(), r.per) for r in out.collect()) == [
        (k, s, 1.0) for k in range(40) for s in [0.001, *[20.001] * 20]]


def test_sketches_per_pane(spark):
    rows = [(i % 3000, 1000 * i) for i in range(20_000)] + [(None, 5000), (1, None)]
    df = frame(spark, rows, "u long, ms long")
    est = {r.window_start: r for r in windows.distinct_by_sketch(df, "u", "ts", "3 hours", "2 hours").collect()}
    exact = windows.pv_per_uv(df, "u", "ts", "3 hours", "2 hours").collect()
    assert {r.window_start for r in exact} == set(est)
    for r in exact:
        assert est[r.window_start].pv == r.pv and abs(est[r.window_start].uv_estimate - r.uv) <= max(1, 4 * windows.SKETCH_ERROR * r.uv)
