from pyspark.sql import functions as F

from conftest import SF_SMALL, frame, hm, ntz, rows_set
from tideline.operators import topn, windows
from tideline.sources.tables import read_table

F12 = [("Alice", "./home", 1000), ("Bob", "./cart", 1000), ("Alice", "./prod?id=1", hm(0, 25)),
       ("Alice", "./prod?id=4", hm(0, 55)), ("Bob", "./prod?id=5", hm(1, 1)), ("Cary", "./home", hm(1, 30)),
       ("Cary", "./prod?id=7", hm(1, 59))]
SCHEMA = "users string, urls string, ms long"


def test_cumulative_golden(spark):
    df = frame(spark, F12, SCHEMA)
    out = windows.cumulative_window(df, "users", "ts", "30 minutes", "1 hour")
    got = rows_set(out, "users", "window_end", "cnt")
    want = sorted([("Alice", ntz(hm(0, 30)), 2), ("Alice", ntz(hm(1)), 3), ("Bob", ntz(hm(0, 30)), 1),
                   ("Bob", ntz(hm(1)), 1), ("Bob", ntz(hm(1, 30)), 1), ("Bob", ntz(hm(2)), 1), ("Cary", ntz(hm(2)), 2)])
    assert got == want


def test_tumble_golden(spark):
    df = frame(spark, F12, SCHEMA)
    out = windows.tumbling_count(df, "users", "ts", "1 hour")
    want = sorted([("Alice", ntz(hm(1)), 3), ("Bob", ntz(hm(1)), 1), ("Bob", ntz(hm(2)), 1), ("Cary", ntz(hm(2)), 2)])
    assert rows_set(out, "users", "window_end", "cnt") == want


def test_window_top2_golden(spark):
    df = frame(spark, F12, SCHEMA)
    c = windows.tumbling_count(df, "users", "ts", "1 hour")
    out = topn.top_n_per_group(c, ["window_start", "window_end"], "cnt", 2, ["users"])
    want = sorted([("Alice", ntz(hm(1)), 3, 1), ("Bob", ntz(hm(1)), 1, 2), ("Cary", ntz(hm(2)), 2, 1),
                   ("Bob", ntz(hm(2)), 1, 2)])
    assert rows_set(out, "users", "window_end", "cnt", "rn") == want
    for bounded in (True, False):
        agg = topn.top_n_by_aggregate(c, ["window_end"], "users", "cnt", 2, bounded=bounded)
        assert rows_set(agg, "users", "window_end", "cnt", "rn") == want


def test_early_fire_snapshots(spark):
    rows = [("a", "x", 1000), ("a", "x", 2500), ("a", "x", 2600), ("a", "x", 9000)]
    out = windows.early_fire(frame(spark, rows, SCHEMA), "users", "ts", "10 seconds", "1 second")
    got = [(r.fire_time, r.cnt) for r in out.orderBy("fire_time").collect()]
    # snapshot at T counts ts <= T; the final firing (window end) holds all rows
    want = [(ntz(1000), 1), (ntz(2000), 1), (ntz(3000), 3)] + [(ntz(t), 3) for t in range(4000, 10000, 1000)] + \
           [(ntz(9000), 4)]
    want = sorted(want[:-2] + [(ntz(9000), 4), (ntz(10000), 4)])
    assert sorted(got) == want


def test_manual_window_equals_builtin(spark):
    ev = read_table(spark, SF_SMALL, "events")
    a = windows.tumbling_count(ev, "user_id", "ts", "1 day")
    b = windows.manual_tumbling_count(ev, "user_id", "ts", "1 day")
    cols = ["user_id", "window_start", "window_end", "cnt"]
    assert rows_set(a, *cols) == rows_set(b, *cols)


def test_window_properties(spark):
    ev = read_table(spark, SF_SMALL, "events")
    total = ev.count()
    tum = windows.tumbling_count(ev, "event_type", "ts", "6 hours")
    assert tum.agg(F.sum("cnt")).first()[0] == total
    sl = windows.sliding_count(ev, "event_type", "ts", "6 hours", "2 hours")
    assert sl.agg(F.sum("cnt")).first()[0] == 3 * total
    cum = windows.cumulative_window(ev, "event_type", "ts", "6 hours", "1 day")
    last = cum.where(F.hour("window_end") == 0)
    day = windows.tumbling_count(ev, "event_type", "ts", "1 day")
    assert rows_set(last, "event_type", "window_start", "cnt") == rows_set(day, "event_type", "window_start", "cnt")


def test_session_windows(spark):
    rows = [("a", "x", 0), ("a", "x", 5000), ("a", "x", 10000), ("a", "x", 16000), ("b", "xx", 0), ("b", "xx", 3000)]
    df = frame(spark, rows, SCHEMA)
    out = windows.session_windows(df, "users", "ts", "5 seconds")
    # a row exactly one gap after the previous joins the session
    assert rows_set(out, "users", "session_start", "cnt") == [("a", ntz(0), 3), ("a", ntz(16000), 1), ("b", ntz(0), 2)]
    dyn = windows.session_windows(df, "users", "ts", F.concat((F.length("urls") * 1000).cast("string"), F.lit(" milliseconds")))
    assert rows_set(dyn, "users", "cnt") == [("a", 1), ("a", 1), ("a", 1), ("a", 1), ("b", 1), ("b", 1)]
