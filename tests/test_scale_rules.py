"""One answer at every size, and no lost or altered rows: splits, null keys and times, equal ids."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import frame, hm, rows_set
from tideline.operators import aggs, joins, ordering, rows, scan, windows
from tideline.operators.sequence import keyed_neighbours, keyed_seq, running_aggregates

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
BIG = 9007199254740993  # not a double


def test_dynamic_gap_reaches_over_a_bucket(spark):
    data = [("a", hm(23), 20), ("a", hm(25), 1), ("a", hm(30), 1), ("a", hm(35), 1), ("a", hm(60), 1)]
    df = frame(spark, data, "k string, ms long, h int")
    gap = F.concat(F.col("h").cast("string"), F.lit(" hours"))
    want = sorted(r.cnt for r in windows.session_windows(df, "k", "ts", gap, aggs=[F.count(F.lit(1)).alias("cnt")]).collect())
    for target in (1, 2, 10):
        assert sorted(r.cnt for r in windows.session_windows(df, "k", "ts", gap, slot="1 hour", target_rows=target).collect()) == want == [1, 4]


EVENTS = st.lists(st.tuples(st.sampled_from(["a", None]), st.integers(0, 100_000), st.integers(1, 30)), min_size=1, max_size=40, unique_by=lambda t: t[1])


@SETTINGS
@given(EVENTS, st.sampled_from([1, 3, 10]))
def test_sessions_with_varying_gaps(spark, data, target):
    df = frame(spark, data, "k string, ms long, s int")
    gap = F.concat(F.col("s").cast("string"), F.lit(" seconds"))
    cols = ["session_start", "session_end", "cnt"]
    plain = windows.session_windows(df, "k", "ts", gap, aggs=[F.count(F.lit(1)).alias("cnt")])
    split = windows.session_windows(df, "k", "ts", gap, slot="1 second", target_rows=target)
    assert rows_set(split, *cols) == rows_set(plain, *cols)


VALUES = st.lists(st.tuples(st.sampled_from(["a", None]), st.one_of(st.none(), st.integers(0, 50_000)), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=30)


@SETTINGS
@given(VALUES, st.sampled_from([1, 4, 1000]))
def test_running_aggregates_with_nulls(spark, data, target):
    data = [(i, *r) for i, r in enumerate(data)]
    df = frame(spark, data, "id long, k string, ms long, v long")
    want = {}
    for key in ("a", None):
        mine = sorted((r for r in data if r[1] == key), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        for n, r in enumerate(mine, 1):
            vs = [x[3] for x in mine[:n] if x[3] is not None]
            want[r[0]] = (n, sum(vs) if vs else None, min(vs) if vs else None, max(vs) if vs else None,
                          mine[n][0] if n < len(mine) else None, mine[n - 3][0] if n > 2 else None)
    run = running_aggregates(df, "k", "ts", "v", tiebreak="id", slot="1 second", target_rows=target)
    got = {r.id: (r.running_count, r.running_sum, r.running_min, r.running_max) for r in run.collect()}
    assert got == {i: w[:4] for i, w in want.items()}
    near = {r.id: (r.seq, r.id_next1, r.id_prev2) for r in keyed_neighbours(df, "k", "ts", ["id"], [1, -2], tiebreak="id", slot="1 second", target_rows=target).collect()}
    assert near == {i: (w[0], w[4], w[5]) for i, w in want.items()}


def test_one_plan_whatever_the_size(spark):
    df = frame(spark, [("a", hm(i), 1) for i in range(5)], "k string, ms long, v int")
    plans = {t: keyed_seq(df, "k", "ts", target_rows=t)._jdf.queryExecution().optimizedPlan().toString() for t in (1, 10**6)}
    shape = {t: [line.split("#")[0].strip().split(" ")[0] for line in p.splitlines()] for t, p in plans.items()}
    assert shape[1] == shape[10**6]


def test_null_and_large_keys_in_folds(spark):
    data = [(BIG, "x", hm(0)), (None, "x", hm(0, 1)), (BIG, "y", hm(1)), (None, "y", hm(1, 1)), (BIG + 1, "x", hm(2))]
    df = frame(spark, data, "k long, e string, ms long")
    for target in (1, 10**6):
        alerts = scan.run_state_machine(df, "k", "ts", "e", [("s", "x", "got"), ("got", "y", "done")], "s", "done", "stop", ["ms", "e"], slot="1 second", target_rows=target)
        assert {(r.k, r.ms, r.e) for r in alerts.collect()} == {(BIG, hm(1), "y"), (None, hm(1, 1), "y")}
        fired = scan.periodic_count(df, "k", "ts", "2 hours", target_rows=target).collect()
        assert sorted((str(r.k), r.cnt) for r in fired) == sorted([(str(BIG), 2), ("None", 2), (str(BIG + 1), 1)])


def test_reconcile_equal_ids_and_null_times(spark):
    left = frame(spark, [("a", 1, hm(1)), ("a", 1, hm(9)), ("a", None, hm(1)), ("a", 2, None), (None, 3, hm(1)), ("a", 4, hm(20)), ("a", 4, hm(20))], "k string, id long, ms long")
    right = frame(spark, [("a", 7, hm(1, 1)), ("a", 8, None), (None, 9, hm(1)), ("b", 9, hm(1))], "k string, id long, ms long")
    got = [(r.k, r.l_id, r.r_id, r.status) for r in joins.reconcile(left, right, "k", "id", "id", "ts", "ts", "5 minutes").collect()]
    want = [("a", 1, 7, "matched"), ("a", None, 7, "matched"), ("a", 1, None, "right_missing"), ("a", 2, None, "right_missing"), (None, 3, None, "right_missing"),
            ("a", 4, None, "right_missing"), ("a", 4, None, "right_missing"), ("a", None, 8, "left_missing"), (None, None, 9, "left_missing"), ("b", None, 9, "left_missing")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_ordering_keeps_null_and_sparse_rows(spark):
    data = [(None, 1)] + [(i * 10**11, i % 5) for i in range(300)]
    df = spark.createDataFrame(data, "o long, v int").repartition(3)
    got = {r.o: (r.idx, r.n) for r in ordering.global_index(df, "o", 1000, total_col="n").collect()}
    assert got == {o: (i, 301) for i, (o, _) in enumerate(data)}
    before = {r.o: r.prev_max for r in ordering.prefix_max_before(df, "o", "v", 1000).collect()}
    assert before == {o: max((v for _, v in data[:i]), default=None) for i, (o, _) in enumerate(data)}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-200, 500)), min_size=1, max_size=30), st.sampled_from([(60, 20), (60, 45), (50, 30), (60, 60)]), st.sampled_from([None, "7 seconds"]))
def test_sliding_panes(spark, data, shape, offset):
    df = frame(spark, [(k, s * 1000) for k, s in data], "k string, ms long")
    size, slide = (f"{x} seconds" for x in shape)
    plain = windows.window_agg(df, "k", "ts", size, slide, offset, aggs=[F.count(F.lit(1)).alias("cnt")])
    cols = ["k", "window_start", "window_end", "cnt"]
    assert rows_set(windows.window_agg(df, "k", "ts", size, slide, offset), *cols) == rows_set(plain, *cols)
    uv = windows.window_agg(df, None, "ts", size, slide, aggs=[F.count(F.lit(1)).alias("pv"), F.countDistinct("k").alias("uv")])
    assert rows_set(windows.pv_per_uv(df, "k", "ts", size, slide), "window_start", "pv", "uv") == rows_set(uv, "window_start", "pv", "uv")


def test_panes_are_counted_before_they_are_copied(spark):
    df = frame(spark, [("a", hm(1))], "k string, ms long")
    plan = windows.sliding_count(df, "k", "ts", "6 hours", "3 hours")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    assert "Expand" not in plan
    generate = next(i for i, x in enumerate(lines) if "Generate" in x)
    assert any("partial_count" in x for x in lines[generate:])


def test_user_aggregate_merges(spark):
    data = [(None if i % 3 == 0 else BIG + i % 3, i % 7, float(i) if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(data, "k long, u long, v double").repartition(4)
    mean = {r.k: r.value for r in rows.user_aggregate(df, "k", ["v"], rows.MeanOf("v"), "double").collect()}
    per = {r.k: r.value for r in rows.user_aggregate(df, "k", ["u"], rows.RowsPerDistinct("u"), "double").collect()}
    for k in {d[0] for d in data}:
        vs = [d[2] for d in data if d[0] == k and d[2] is not None]
        assert abs(mean[k] - sum(vs) / len(vs)) < 1e-9
        assert per[k] == sum(d[0] == k for d in data) / len({d[1] for d in data if d[0] == k})
    assert rows.user_aggregate(df.limit(0), "k", ["v"], rows.MeanOf("v"), "double").count() == 0


def test_changelog_of_a_null_key(spark):
    df = frame(spark, [(None, hm(1)), (None, hm(2)), ("a", hm(1))], "k string, ms long")
    got = sorted((str(r.k), r.op, r.cnt) for r in aggs.changelog_count(df, "k", "ts", target_rows=1).collect())
    assert got == sorted([("None", "+I", 1), ("None", "-U", 1), ("None", "+U", 2), ("a", "+I", 1)])


@pytest.mark.parametrize("agg", [rows.MeanOf("v"), rows.RowsPerDistinct("v")])
def test_many_small_groups_at_once(agg):
    values = pd.DataFrame({"v": [1.0, None, 2.0, 2.0, 5.0, None, None, 1.0]})
    at, accs = np.array([0, 1, 2, 5]), [agg.add(agg.create(), values[3:5]), *(agg.create() for _ in range(3))]
    one_by_one = [agg.add(acc, values[a:b]) for acc, a, b in zip(accs, [0, 1, 2, 5], [1, 2, 5, 8])]
    assert agg.add_groups(accs, values, at) == one_by_one


def test_groups_cost_no_call_each(spark):
    """Accumulators of a group are one stretch of a sorted task, across batches too; odd keys are groups like others."""
    nan, data = float("nan"), []
    for i in range(3000):
        data.append(([nan, None, 0.0, -0.0, 1.5][i % 5], i % 3 or None, i))
    df = spark.createDataFrame(data, "a double, b long, v long").repartition(7)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = rows.user_aggregate(df, ["a", "b"], ["v"], rows.RowsPerDistinct("v"), "double", "per")
        assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
        got = sorted((str(None if r.a is None else r.a + 0.0), str(r.b), r.per) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == sorted((a, b, 1.0) for a in ("nan", "None", "0.0", "1.5") for b in ("None", "1", "2"))
