"""Property tests: operators against brute force on generated inputs, with
random split parameters (bucket width, hot-key threshold, partitions)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import frame, rows_set
from tideline.operators import joins, patterns, windows
from tideline.operators.sequence import keyed_neighbours

EVENTS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["x", "y"]),
                            st.integers(min_value=0, max_value=200_000)),
                  min_size=1, max_size=40, unique_by=lambda t: t[2])
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "k string, e string, ms long"


@SETTINGS
@given(EVENTS, st.sampled_from(["1 second", "7 seconds", "1 minute"]), st.sampled_from([1, 3, 10**6]),
       st.integers(min_value=1, max_value=5))
def test_neighbours_bruteforce(spark, rows, bucket, hot, parts):
    df = frame(spark, rows, SCHEMA).repartition(parts)
    got = keyed_neighbours(df, "k", "ts", ["ms"], [1, -2], tiebreak="ms", slot=bucket, target_rows=hot)
    want = []
    for k in {r[0] for r in rows}:
        ms = sorted(r[2] for r in rows if r[0] == k)
        for i, m in enumerate(ms):
            want.append((k, m, ms[i + 1] if i + 1 < len(ms) else None, ms[i - 2] if i >= 2 else None))
    out = sorted((r.k, r.ms, r.ms_next1, r.ms_prev2) for r in got.collect())
    assert out == sorted(want)


@SETTINGS
@given(EVENTS, EVENTS, st.integers(min_value=-20_000, max_value=0), st.integers(min_value=0, max_value=30_000))
def test_interval_join_bruteforce(spark, left, right, lo, hi):
    ldf, rdf = frame(spark, left, SCHEMA), frame(spark, right, SCHEMA)
    got = joins.interval_join(ldf, rdf, "k", "ts", "ts", f"{lo} milliseconds", f"{hi} milliseconds")
    want = sorted((a[0], a[2], b[2]) for a in left for b in right if a[0] == b[0] and a[2] + lo <= b[2] <= a[2] + hi)
    assert rows_set(got, "k", "l_ms", "r_ms") == want


@SETTINGS
@given(EVENTS, st.integers(min_value=1, max_value=60))
def test_followed_by_bruteforce(spark, rows, within_s):
    df = frame(spark, rows, SCHEMA).withColumn("id", F.col("ms"))
    got = patterns.followed_by_within(df, "k", "ts", F.col("e") == "x", F.col("e") == "y", f"{within_s} seconds", "id")
    want = []
    for k, e, m in rows:
        if e != "x":
            continue
        later = sorted(r[2] for r in rows if r[0] == k and r[1] == "y" and r[2] > m)
        hit = later and later[0] - m < within_s * 1000
        want.append((k, m, later[0] if hit else None, "matched" if hit else "timeout"))
    assert sorted(want, key=str) == sorted(((r.k, r.start_id, r.end_id, r.status) for r in got.collect()), key=str)


@SETTINGS
@given(EVENTS)
def test_window_identities(spark, rows):
    df = frame(spark, rows, SCHEMA)
    tum = windows.tumbling_count(df, "k", "ts", "1 minute")
    cum = windows.cumulative_window(df, "k", "ts", "20 seconds", "1 minute")
    last = cum.where(F.col("window_end") == F.col("window_start") + F.expr("INTERVAL 1 MINUTE"))
    assert rows_set(last, "k", "window_start", "cnt") == rows_set(tum, "k", "window_start", "cnt")
    sl = windows.sliding_count(df, "k", "ts", "1 minute", "20 seconds")
    assert sl.agg(F.sum("cnt")).first()[0] == 3 * len(rows)


@SETTINGS
@given(EVENTS, st.sampled_from(["3 seconds", "20 seconds"]), st.sampled_from(["10 seconds", "1 minute"]),
       st.sampled_from([1, 2, 10**6]))
def test_session_split_equals_plain(spark, rows, gap, bucket, hot):
    df = frame(spark, rows, SCHEMA)
    plain = windows.session_windows(df, "k", "ts", gap, aggs=[F.count(F.lit(1)).alias("cnt")])
    split = windows.session_windows(df, "k", "ts", gap, slot=bucket, target_rows=hot)
    cols = ["k", "session_start", "session_end", "cnt"]
    assert rows_set(split, *cols) == rows_set(plain, *cols)
    dyn = F.concat((F.length("e") * 4).cast("string"), F.lit(" seconds"))
    p2 = windows.session_windows(df, "k", "ts", dyn, aggs=[F.count(F.lit(1)).alias("cnt")])
    s2 = windows.session_windows(df, "k", "ts", dyn, slot=bucket, target_rows=hot)
    assert rows_set(s2, *cols) == rows_set(p2, *cols)


@SETTINGS
@given(EVENTS, st.integers(min_value=1, max_value=40), st.sampled_from(["1 second", "10 seconds", "5 minutes"]))
def test_periodic_count_split_bruteforce(spark, rows, iv_s, bucket):
    from tideline.operators import scan
    df = frame(spark, rows, SCHEMA)
    iv = iv_s * 10**6
    want = []
    for k in {r[0] for r in rows}:
        ts = sorted(r[2] * 1000 for r in rows if r[0] == k)
        i = 0
        while i < len(ts):
            fire = ts[i] + iv
            j = i
            while j < len(ts) and ts[j] <= fire:
                j += 1
            want.append((k, fire, j))
            i = j
    got = scan.periodic_count(df, "k", "ts", f"{iv_s} seconds", slot=bucket, target_rows=1)
    assert rows_set(got, "k", "fire_us", "cnt") == sorted(want)


@SETTINGS
@given(EVENTS, EVENTS, st.integers(min_value=0, max_value=20))
def test_reconcile_bruteforce(spark, left, right, tol_s):
    ldf, rdf = frame(spark, left, SCHEMA), frame(spark, right, SCHEMA)
    got = joins.reconcile(ldf, rdf, "k", "ms", "ms", "ts", "ts", f"{tol_s} seconds")
    tol = tol_s * 1000
    want = [(a[0], a[2], b[2], "matched") for a in left for b in right if a[0] == b[0] and abs(a[2] - b[2]) <= tol]
    want += [(a[0], a[2], None, "right_missing") for a in left
             if not any(a[0] == b[0] and abs(a[2] - b[2]) <= tol for b in right)]
    want += [(b[0], None, b[2], "left_missing") for b in right
             if not any(a[0] == b[0] and abs(a[2] - b[2]) <= tol for a in left)]
    out = [(r.k, r.l_id, r.r_id, r.status) for r in got.collect()]
    assert sorted(out, key=str) == sorted(want, key=str)
