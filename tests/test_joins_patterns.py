from pyspark.sql import functions as F

from conftest import SF_SMALL, frame, ntz, rows_set
from tideline.operators import joins, patterns, scan
from tideline.plans.event_patterns import LOGIN_FAIL_TRANSITIONS
from tideline.sources.tables import read_table


def test_window_join_and_cogroup_golden(spark):
    left = frame(spark, [("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000)], "k string, ms long")
    right = frame(spark, [("a", 3000), ("b", 3000), ("a", 4000), ("b", 4000)], "k string, ms long")
    j = joins.window_join(left, right, "k", "ts", "ts", "5 seconds")
    assert j.count() == 8
    g = joins.window_cogroup(left, right, "k", "ts", "ts", "5 seconds", "ms", "ms")
    assert rows_set(g, "k", "left_values", "right_values") == [("a", [1000, 2000], [3000, 4000]),
                                                                ("b", [1000, 2000], [3000, 4000])]


def test_interval_join_golden(spark):
    orders = frame(spark, [("Mary", "order-1", 5000), ("Alice", "order-2", 5000), ("Bob", "order-3", 20000),
                           ("Alice", "order-4", 20000), ("Cary", "order-5", 51000)], "users string, oid string, ms long")
    clicks = frame(spark, [("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Alice", "./prod?id=200", 3500),
                           ("Bob", "./prod?id=2", 2500), ("Alice", "./prod?id=300", 36000), ("Bob", "./home", 30000),
                           ("Bob", "./prod?id=1", 23000), ("Bob", "./prod?id=3", 33000)], "users string, urls string, ms long")
    j = joins.interval_join(orders, clicks, "users", "ts", "ts", "-5 seconds", "10 seconds")
    assert rows_set(j, "l_oid", "r_ms") == [("order-2", 3000), ("order-2", 3500), ("order-3", 23000), ("order-3", 30000)]


def test_reconcile_golden(spark):
    app = frame(spark, [("order-1", "app", 1000), ("order-2", "app", 2000)], "oid string, src string, ms long")
    pay = frame(spark, [("order-1", "third-party", "success", 3000), ("order-3", "third-party", "success", 4000)],
                "oid string, src string, status string, ms long")
    out = joins.reconcile(app, pay, "oid", "ms", "ms", "ts", "ts", "5 seconds")
    assert rows_set(out, "oid", "status") == [("order-1", "matched"), ("order-2", "right_missing"),
                                              ("order-3", "left_missing")]


def test_inner_join_and_rules_golden(spark):
    a = frame(spark, [("a", "stream-1", 1000), ("b", "stream-1", 2000)], "k string, src string, ms long")
    b = frame(spark, [("a", "stream-2", 3000), ("b", "stream-2", 4000)], "k2 string, src2 string, ms2 long")
    j = joins.equi_join(a, b, ["k"], ["k2"])
    assert rows_set(j, "k", "ms", "ms2") == [("a", 1000, 3000), ("b", 2000, 4000)]
    acts = frame(spark, [("Alice", "login", 1), ("Alice", "pay", 2), ("Bob", "login", 3), ("Bob", "buy", 4)],
                 "user_id string, action string, ms long")
    rules = spark.createDataFrame([("login", "pay"), ("login", "buy")], "action1 string, action2 string")
    out = joins.consecutive_pair_rules(acts, "user_id", "ts", "action", rules, slot="1 millisecond", target_rows=1)
    assert rows_set(out, "user_id", "prev_action", "action") == [("Alice", "login", "pay"), ("Bob", "login", "buy")]


F14 = [("user_1", "192.168.0.1", "fail", 2000), ("user_1", "192.168.0.2", "fail", 3000),
       ("user_2", "192.168.1.29", "fail", 4000), ("user_1", "171.56.23.10", "fail", 5000),
       ("user_2", "192.168.1.29", "success", 6000), ("user_2", "192.168.1.29", "fail", 7000),
       ("user_2", "192.168.1.29", "fail", 8000)]
LOGIN = "user_id string, ip string, event_type string, ms long"


def test_three_fails_golden(spark):
    df = frame(spark, F14, LOGIN)
    f = F.col("event_type") == "fail"
    out = patterns.strict_sequence(df, "user_id", "ts", [f, f, f], ["ms"], slot="1 second", target_rows=1)
    assert rows_set(out, "user_id", "ms_1", "ms_2", "ms_3") == [("user_1", 2000, 3000, 5000)]
    tr = [(s, "fail" if e == "error" else "success", n) for s, e, n in LOGIN_FAIL_TRANSITIONS]
    sm = scan.run_state_machine(df, "user_id", "ts", "event_type", tr, "Initial", "Matched", "Terminal", ["ms"])
    assert rows_set(sm, "user_id", "ms") == [("user_1", 5000)]


def test_order_timeout_golden(spark):
    rows = [("user_1", "order_1", "create", 1000), ("user_2", "order_2", "create", 2000),
            ("user_1", "order_1", "modify", 10000), ("user_1", "order_1", "pay", 60000),
            ("user_2", "order_3", "create", 600000), ("user_2", "order_3", "pay", 1200000)]
    df = frame(spark, rows, "user_id string, order_id string, event_type string, ms long").withColumn(
        "id", F.col("ms"))
    out = patterns.followed_by_within(df, "order_id", "ts", F.col("event_type") == "create",
                                      F.col("event_type") == "pay", "15 minutes", "id")
    assert rows_set(out, "order_id", "status") == [("order_1", "matched"), ("order_2", "timeout"),
                                                   ("order_3", "matched")]


def _brute_periodic(pdf, iv_us):
    out = []
    for k, g in pdf.groupby("user_id"):
        ts = sorted(g.us)
        i, n = 0, len(ts)
        while i < n:
            fire = ts[i] + iv_us
            j = i
            while j < n and ts[j] <= fire:
                j += 1
            out.append((k, fire, j))
            i = j
    return sorted(out)


def test_periodic_count_bruteforce(spark):
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id")
    pdf = ev.toPandas()
    import pandas as pd
    pdf["us"] = (pdf.ts - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    want = _brute_periodic(pdf, 10 * 3600 * 10**6)
    got = scan.periodic_count(ev, "user_id", "ts", "10 hours", tiebreak="event_id", partitions=3)
    assert rows_set(got, "user_id", "fire_us", "cnt") == want


def test_followed_by_bruteforce(spark):
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id", "event_type")
    pdf = ev.toPandas().sort_values(["ts", "event_id"])
    want = []
    day = 86400 * 10**6
    for r in pdf[pdf.event_type == "signup"].itertuples():
        later = pdf[(pdf.user_id == r.user_id) & (pdf.event_type == "purchase") & (pdf.ts > r.ts)]
        hit = len(later) and (later.ts.iloc[0] - r.ts).value // 1000 < day
        want.append((r.event_id, int(later.event_id.iloc[0]) if hit else None))
    for bucket_check in ["1 day"]:
        out = patterns.followed_by_within(ev, "user_id", "ts", F.col("event_type") == "signup",
                                          F.col("event_type") == "purchase", bucket_check, "event_id")
        assert rows_set(out, "start_id", "end_id") == sorted(want, key=lambda t: (t[0], t[1] or -1))


def test_sequence_hot_key_split(spark):
    """One key holding every row: results do not depend on the bucket width
    (which is what splits the hot key across tasks)."""
    ev = read_table(spark, SF_SMALL, "events").withColumn("user_id", F.lit(1))
    e = F.col("event_type") == "error"
    base = rows_set(patterns.strict_sequence(ev, "user_id", "ts", [e, e], ["event_id"], tiebreak="event_id",
                                             slot="365 days"), "event_id_1", "event_id_2")
    for b in ["1 hour", "6 hours"]:
        got = rows_set(patterns.strict_sequence(ev, "user_id", "ts", [e, e], ["event_id"], tiebreak="event_id",
                                                slot=b, target_rows=100), "event_id_1", "event_id_2")
        assert got == base and len(base) > 0


def test_state_machine_split_equals_sequential(spark):
    """The bucketed state machine (entry state per bucket from composed
    functions) equals a plain sequential run, for cold keys, hot keys and one
    key holding every row."""
    import pandas as pd
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "event_id", "ts", "event_type")
    pdf = ev.toPandas().sort_values(["ts", "event_id"])
    table = {(s, a): n for s, a, n in LOGIN_FAIL_TRANSITIONS}

    def brute(frame):
        out, state = [], {}
        for r in frame.itertuples():
            st = state.get(r.user_id, "Initial")
            nxt = table.get((st, r.event_type), "Initial")
            if nxt == "Matched":
                out.append(r.event_id)
            else:
                state[r.user_id] = "Initial" if nxt == "Terminal" else nxt
        return sorted(out)

    want = brute(pdf)
    for bucket, hot in [("1 day", None), ("6 hours", 5), ("1 day", 10**9)]:
        got = scan.run_state_machine(ev, "user_id", "ts", "event_type", LOGIN_FAIL_TRANSITIONS, "Initial", "Matched",
                                     "Terminal", ["event_id"], tiebreak="event_id", slot=bucket, target_rows=hot)
        assert sorted(r.event_id for r in got.collect()) == want
    one = ev.withColumn("user_id", F.lit(7))
    want_one = brute(pdf.assign(user_id=7))
    got = scan.run_state_machine(one, "user_id", "ts", "event_type", LOGIN_FAIL_TRANSITIONS, "Initial", "Matched",
                                 "Terminal", ["event_id"], tiebreak="event_id", slot="2 hours", target_rows=100)
    assert sorted(r.event_id for r in got.collect()) == want_one and len(want_one) > 0


def test_periodic_count_across_arrow_batches(spark):
    """State carried across Arrow batches and keys: tiny batches, one key with
    every row, and the normal layout all equal brute force."""
    import pandas as pd
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id")
    pdf = ev.toPandas()
    pdf["us"] = (pdf.ts - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    iv = 3 * 3600 * 10**6
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = scan.periodic_count(ev, "user_id", "ts", "3 hours", tiebreak="event_id", partitions=2)
        assert rows_set(got, "user_id", "fire_us", "cnt") == _brute_periodic(pdf, iv)
        one = ev.withColumn("user_id", F.lit(1))
        got1 = scan.periodic_count(one, "user_id", "ts", "3 hours", tiebreak="event_id")
        assert rows_set(got1, "user_id", "fire_us", "cnt") == _brute_periodic(pdf.assign(user_id=1), iv)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_periodic_count_hot_keys_split(spark):
    """Keys split into buckets and joined up by pointer doubling equal brute force."""
    import pandas as pd
    ev = read_table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id")
    pdf = ev.toPandas()
    pdf["us"] = (pdf.ts - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    for iv_h, slot, target in [(10, "1 day", 1), (3, "1 second", 2), (1, "2 hours", 1)]:
        got = scan.periodic_count(ev, "user_id", "ts", f"{iv_h} hours", tiebreak="event_id", slot=slot, target_rows=target)
        assert rows_set(got, "user_id", "fire_us", "cnt") == _brute_periodic(pdf, iv_h * 3600 * 10**6), (iv_h, slot)
    one = ev.withColumn("user_id", F.lit(1))
    got1 = scan.periodic_count(one, "user_id", "ts", "20 minutes", tiebreak="event_id", target_rows=100)
    assert rows_set(got1, "user_id", "fire_us", "cnt") == _brute_periodic(pdf.assign(user_id=1), 20 * 60 * 10**6)
