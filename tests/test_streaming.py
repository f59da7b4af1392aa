import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, frame, hm, ntz, rows_set
from tideline.functions.time import epoch_us
from tideline.operators import scan, windows
from tideline.plans.event_patterns import LOGIN_FAIL_TRANSITIONS
from tideline.sources.tables import read_table
from tideline.streaming import feeds, ops, sinks, stateful, topn
from streams import run_to_memory, stream_parts
from tideline.streaming.replay import read_replay, replay_to_files


def _stream_batches(spark, batches, schema, scratch, name="in"):
    """Each list of rows becomes one parquet file = one micro-batch."""
    parts = []
    for i, rows in enumerate(batches):
        p = os.path.join(scratch, f"{name}_src_{i}")
        frame(spark, rows, schema).coalesce(1).write.parquet(p)
        parts.append(p)
    src_schema = frame(spark, batches[0], schema).schema
    return stream_parts(spark, parts, src_schema, os.path.join(scratch, f"{name}_landing"))


F12 = [("Alice", "./home", 1000), ("Bob", "./cart", 1000), ("Alice", "./prod?id=1", hm(0, 25)),
       ("Alice", "./prod?id=4", hm(0, 55)), ("Bob", "./prod?id=5", hm(1, 1)), ("Cary", "./home", hm(1, 30)),
       ("Cary", "./prod?id=7", hm(1, 59))]
EV = "users string, urls string, ms long"


def test_cumulative_stream_golden(spark, scratch):
    s = _stream_batches(spark, [F12[:4], F12[4:], [("Zed", "./x", hm(10))]], EV, scratch)
    out = run_to_memory(ops.cumulative_count(s, "users", "ts", "30 minutes", "1 hour"), "append",
                        os.path.join(scratch, "ck"))
    want = sorted([("Alice", ntz(hm(0, 30)), 2), ("Alice", ntz(hm(1)), 3), ("Bob", ntz(hm(0, 30)), 1),
                   ("Bob", ntz(hm(1)), 1), ("Bob", ntz(hm(1, 30)), 1), ("Bob", ntz(hm(2)), 1), ("Cary", ntz(hm(2)), 2)])
    assert rows_set(out, "users", "window_end", "cnt") == want


def test_top_n_stream_golden(spark, scratch):
    s = _stream_batches(spark, [F12[:4], F12[4:], [("Zed", "./x", hm(10))]], EV, scratch)
    out = run_to_memory(topn.windowed_top_n(s, "users", "ts", "1 hour", None, 2), "append", os.path.join(scratch, "ck"))
    want = sorted([("Alice", ntz(hm(1)), 3), ("Bob", ntz(hm(1)), 1), ("Cary", ntz(hm(2)), 2), ("Bob", ntz(hm(2)), 1)])
    assert rows_set(out, "users", "window_end", "cnt") == want


def test_interval_join_stream_golden(spark, scratch):
    orders = [("Mary", "order-1", 5000), ("Alice", "order-2", 5000), ("Bob", "order-3", 20000),
              ("Alice", "order-4", 20000), ("Cary", "order-5", 51000)]
    clicks = [("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Alice", "./prod?id=200", 3500),
              ("Bob", "./prod?id=2", 2500), ("Alice", "./prod?id=300", 36000), ("Bob", "./home", 30000),
              ("Bob", "./prod?id=1", 23000), ("Bob", "./prod?id=3", 33000)]
    lo = _stream_batches(spark, [orders[:2], orders[2:]], "users string, oid string, ms long", scratch, "o")
    ro = _stream_batches(spark, [clicks[:4], clicks[4:]], "users string, urls string, ms long", scratch, "c")
    out = run_to_memory(ops.interval_join(lo, ro, "users", "ts", "ts", "-5 seconds", "10 seconds", delay="30 seconds"),
                        "append", os.path.join(scratch, "ck"))
    assert rows_set(out, "l_oid", "r_ms") == [("order-2", 3000), ("order-2", 3500), ("order-3", 23000),
                                              ("order-3", 30000)]


def test_event_time_timers_golden(spark, scratch):
    s = _stream_batches(spark, [[("Mary", "./home", 1000)], [("Mary", "./home", 11000)], [("Alice", "./cart", 11001)],
                                [("Zed", "./x", 100000)]], EV, scratch)
    out = run_to_memory(stateful.event_time_timers(s, "users", "ts", "10 seconds"), "append",
                        os.path.join(scratch, "ck"))
    assert rows_set(out, "k", "timer_ms") == [("Alice", 21001), ("Mary", 11000), ("Mary", 21000)]


def test_order_timeout_stream_golden(spark, scratch):
    rows = [("user_1", "order_1", "create", 1000), ("user_2", "order_2", "create", 2000),
            ("user_1", "order_1", "modify", 10000), ("user_1", "order_1", "pay", 60000),
            ("user_2", "order_3", "create", 600000), ("user_2", "order_3", "pay", 1200000)]
    s = _stream_batches(spark, [rows[:3], rows[3:]], "user_id string, order_id string, event_type string, ms long",
                        scratch).withColumn("id", F.col("ms"))
    q = stateful.followed_by_stream(s, "order_id", "ts", F.col("event_type") == "create",
                                    F.col("event_type") == "pay", "15 minutes", "id")
    out = run_to_memory(q, "append", os.path.join(scratch, "ck"))
    assert rows_set(out, "k", "status") == [("order_1", "matched"), ("order_2", "timeout"), ("order_3", "matched")]


def test_state_machine_and_changelog_stream(spark, scratch):
    f14 = [("user_1", "fail", 2000), ("user_1", "fail", 3000), ("user_2", "fail", 4000), ("user_1", "fail", 5000),
           ("user_2", "success", 6000), ("user_2", "fail", 7000), ("user_2", "fail", 8000)]
    s = _stream_batches(spark, [f14[:3], f14[3:]], "user_id string, event_type string, ms long", scratch)
    tr = [(a, "fail" if e == "error" else "success", n) for a, e, n in LOGIN_FAIL_TRANSITIONS]
    out = run_to_memory(stateful.state_machine_stream(s, "user_id", "ts", "event_type", "ms", tr, "Initial",
                                                      "Matched", "Terminal"), "append", os.path.join(scratch, "ck1"))
    assert rows_set(out, "k", "ms") == [("user_1", 5000)]
    f13 = [("Alice", "./home", 1000), ("Bob", "./cart", 1000), ("Alice", "./prod?id=1", 5000),
           ("Cary", "./home", 60000), ("Bob", "./prod?id=3", 90000), ("Alice", "./prod?id=7", 105000)]
    s2 = _stream_batches(spark, [f13[:3], f13[3:]], EV, scratch, "f13")
    ch = run_to_memory(stateful.changelog_stream(s2, "users", "ts", "ms"), "append", os.path.join(scratch, "ck2"))
    assert sorted((r.op, r.k, r.cnt) for r in ch.collect()) == sorted(
        [("+I", "Alice", 1), ("+I", "Bob", 1), ("-U", "Alice", 1), ("+U", "Alice", 2), ("+I", "Cary", 1),
         ("-U", "Bob", 1), ("+U", "Bob", 2), ("-U", "Alice", 2), ("+U", "Alice", 3)])


def test_stream_equals_batch_on_events(spark, scratch):
    """Replay of the events table: closed windows and fired timers of the
    stream equal the batch operators restricted to what the final watermark
    has passed."""
    ev = read_table(spark, SF_SMALL, "events")
    parts = replay_to_files(ev, scratch, 4, "event_id")
    s = read_replay(spark, parts[0], ev.schema)
    out = run_to_memory(ops.window_count(s, "event_type", "ts", "6 hours", delay="1 hour"), "append",
                        os.path.join(scratch, "ck"))
    max_ts = ev.agg(F.max("ts")).first()[0]
    import datetime
    wm = max_ts - datetime.timedelta(hours=1)
    batch = windows.tumbling_count(ev, "event_type", "ts", "6 hours").where(F.col("window_end") <= F.lit(wm))
    cols = ["event_type", "window_start", "window_end", "cnt"]
    assert rows_set(out, *cols) == rows_set(batch, *cols)

    s2 = read_replay(spark, parts[0], ev.schema)
    pv = run_to_memory(stateful.periodic_count_stream(s2, "user_id", "ts", "10 hours"), "append",
                       os.path.join(scratch, "ck2"))
    wm_ms = int((max_ts - datetime.datetime(1970, 1, 1)).total_seconds() * 1000)
    b = scan.periodic_count(ev, "user_id", "ts", "10 hours", tiebreak="event_id")
    b = b.withColumn("fire_ms", F.floor(F.col("fire_us") / 1000).cast("bigint")).where(F.col("fire_ms") <= wm_ms)
    got = rows_set(pv.withColumnRenamed("k", "user_id"), "user_id", "fire_ms", "cnt")
    assert got == rows_set(b, "user_id", "fire_ms", "cnt")


def test_reconcile_and_joins_stream_golden(spark, scratch):
    app = [("order-1", "app", 1000), ("order-2", "app", 2000)]
    pay = [("order-1", "third-party", 3000), ("order-3", "third-party", 4000)]
    later_a = [("zz", "app", 60000)]
    later_p = [("zz", "third-party", 60000)]
    a = _stream_batches(spark, [app, later_a], "oid string, src string, ms long", scratch, "a")
    p = _stream_batches(spark, [pay, later_p], "oid string, src string, ms long", scratch, "p")
    out = run_to_memory(ops.reconcile(a, p, "oid", "ts", "ts", "5 seconds"), "append", os.path.join(scratch, "ck"))
    got = sorted((r.l_oid or r.r_oid, r.status) for r in out.collect() if (r.l_oid or r.r_oid) != "zz")
    assert got == [("order-1", "matched"), ("order-2", "right_missing"), ("order-3", "left_missing")]

    l = _stream_batches(spark, [[("a", 1000), ("b", 2000)]], "k string, ms long", scratch, "l")
    r = _stream_batches(spark, [[("a", 3000), ("b", 4000)]], "k2 string, ms2 long", scratch, "r")
    j = run_to_memory(ops.equi_join(l, r, "k", "k2"), "append", os.path.join(scratch, "ck2"))
    assert rows_set(j, "k", "ms", "ms2") == [("a", 1000, 3000), ("b", 2000, 4000)]


def test_window_join_cogroup_stream_golden(spark, scratch):
    lrows = [("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000)]
    rrows = [("a", 3000), ("b", 3000), ("a", 4000), ("b", 4000)]
    l = _stream_batches(spark, [lrows, [("z", 20000)]], "k string, ms long", scratch, "l")
    r = _stream_batches(spark, [rrows, [("z", 20000)]], "k string, ms long", scratch, "r")
    j = run_to_memory(ops.window_join(l, r, "k", "ts", "ts", "5 seconds"), "append", os.path.join(scratch, "ck"))
    assert j.where("l_k != 'z'").count() == 8
    l2 = _stream_batches(spark, [lrows, [("z", 20000)]], "k string, ms long", scratch, "l2")
    r2 = _stream_batches(spark, [rrows, [("z", 20000)]], "k string, ms long", scratch, "r2")
    g = run_to_memory(ops.window_cogroup(l2, r2, "k", "ts", "ts", "5 seconds", "ms", "ms"), "append",
                      os.path.join(scratch, "ck2"))
    assert rows_set(g, "k", "left_values", "right_values") == [("a", [1000, 2000], [3000, 4000]),
                                                                ("b", [1000, 2000], [3000, 4000])]


def test_rules_and_first_n_stream(spark, scratch):
    acts = [("Alice", "login", 1), ("Alice", "pay", 2), ("Bob", "login", 3), ("Bob", "buy", 4)]
    s = _stream_batches(spark, [acts[:1] + acts[2:3], acts[1:2] + acts[3:]], "user_id string, action string, ms long",
                        scratch)
    rules = spark.createDataFrame([("login", "pay"), ("login", "buy")], "action1 string, action2 string")
    out = run_to_memory(stateful.rule_matches_stream(s, "user_id", "ts", "action", "ms", rules), "append",
                        os.path.join(scratch, "ck"))
    assert rows_set(out, "k", "prev_action", "action") == [("Alice", "login", "pay"), ("Bob", "login", "buy")]
    rows = [("u", "x", 1000 * i) for i in range(1, 8)]
    s2 = _stream_batches(spark, [rows[:3], rows[3:]], EV, scratch, "n")
    avg = run_to_memory(stateful.first_n_average_stream(s2, "users", "ts", "ms", 5), "append", os.path.join(scratch, "ck2"))
    assert rows_set(avg, "k", "avg_ms") == [("u", 3000)]


def test_sinks_stream(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events")
    parts = replay_to_files(ev, scratch, 3, "event_id")
    s = read_replay(spark, parts[0], ev.schema)
    q = sinks.buffered_batches_sink(s.select("event_id"), "event_id", 7, os.path.join(scratch, "out"),
                                    os.path.join(scratch, "state"), os.path.join(scratch, "ck"))
    q.awaitTermination(180)
    out = spark.read.parquet(os.path.join(scratch, "out"))
    n = ev.count()
    assert out.count() == (n // 7) * 7
    assert rows_set(out.select("event_id").orderBy("event_id").limit(3), "event_id") == [(0,), (1,), (2,)]
    s2 = read_replay(spark, parts[0], ev.schema)
    q2 = sinks.rolling_file_sink(s2, os.path.join(scratch, "files"), os.path.join(scratch, "ck2"),
                                 max_records_per_file=100, available_now=True)
    q2.awaitTermination(180)
    files = spark.read.parquet(os.path.join(scratch, "files"))
    assert files.count() == n


def test_late_split_stream_matches_batch(spark, scratch):
    from tideline.operators import eventtime
    ev = read_table(spark, SF_SMALL, "events").select("event_id", "ts")
    ev = ev.withColumn("arrival", F.col("event_id") + F.pmod(F.col("event_id") * 37, F.lit(50)))
    # stream in arrival order: order files by arrival
    evk = ev.withColumn("arrival_key", F.col("arrival") * 10000 + F.col("event_id"))
    parts = replay_to_files(evk, scratch, 3, "arrival_key")
    s = read_replay(spark, parts[0], evk.schema)
    q = sinks.late_split_sink(s, "ts", "arrival_key", "1 hour", "5 minutes", os.path.join(scratch, "out"),
                              os.path.join(scratch, "state"), os.path.join(scratch, "ck"))
    q.awaitTermination(180)
    got = spark.read.parquet(os.path.join(scratch, "out"))
    b = eventtime.split_late(evk, "ts", "arrival_key", "1 hour", "5 minutes")
    assert rows_set(got.where("route = 'late'"), "event_id") == rows_set(b.where("is_late"), "event_id")
    assert b.where("is_late").count() > 0


def test_more_stream_forms_equal_batch(spark, scratch):
    """Count windows, strict 3-in-a-row, early firing and running aggregates
    on the replayed events equal their batch operators."""
    from tideline.operators import aggs, patterns
    ev = read_table(spark, SF_SMALL, "events")
    folder = replay_to_files(ev, scratch, 4, "event_id")[0]

    s = read_replay(spark, folder, ev.schema)
    cw = run_to_memory(stateful.count_window_stream(s, "user_id", "ts", "value", "event_id", 5, 2), "append",
                       os.path.join(scratch, "ck1"))
    b = aggs.count_window_sliding(ev, "user_id", "ts", 5, 2, "value", tiebreak="event_id")
    assert rows_set(cw.withColumnRenamed("k", "user_id").withColumn("total", F.round("total", 6)),
                    "user_id", "fire_seq", "cnt", "total") == \
        rows_set(b.withColumn("total", F.round("total", 6)), "user_id", "fire_seq", "cnt", "total")

    s = read_replay(spark, folder, ev.schema)
    e = F.col("event_type") == "error"
    st = run_to_memory(stateful.strict_sequence_stream(s, "user_id", "ts", "event_id", [e, e, e]), "append",
                       os.path.join(scratch, "ck2"))
    bb = patterns.strict_sequence(ev, "user_id", "ts", [e, e, e], ["event_id"], tiebreak="event_id")
    assert sorted(tuple(r.ids) for r in st.collect()) == rows_set(bb, "event_id_1", "event_id_2", "event_id_3")

    s = read_replay(spark, folder, ev.schema)
    ef = run_to_memory(ops.early_fire_count(s, "event_type", "ts", "1 day", "6 hours"), "append",
                       os.path.join(scratch, "ck3"))
    max_ts = ev.agg(F.max("ts")).first()[0]
    be = windows.early_fire(ev, "event_type", "ts", "1 day", "6 hours").where(F.col("window_end") <= F.lit(max_ts))
    cols = ["event_type", "window_start", "fire_time", "cnt"]
    assert rows_set(ef, *cols) == rows_set(be, *cols)

    s = read_replay(spark, folder, ev.schema)
    ra = run_to_memory(ops.running_aggregate(s, "user_id", [F.count(F.lit(1)).alias("cnt")]), "update",
                       os.path.join(scratch, "ck4"))
    final = ra.groupBy("user_id").agg(F.max("cnt").alias("cnt"))
    assert rows_set(final, "user_id", "cnt") == rows_set(ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt")),
                                                         "user_id", "cnt")


def test_restart_from_checkpoint(spark, scratch):
    """Stop after half the input, restart on the same checkpoint with the rest
    added: the output equals one uninterrupted run."""
    from tideline.streaming.replay import run_to_parquet
    ev = read_table(spark, SF_SMALL, "events")
    mid = ev.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY event_id)")).first()[0]
    land = os.path.join(scratch, "landing")
    ev.where(F.col("event_id") <= mid).repartitionByRange(2, "event_id").write.parquet(land)
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")

    def query():
        s = read_replay(spark, land, ev.schema, files_per_trigger=1)
        return ops.window_count(s, "event_type", "ts", "6 hours", delay="1 hour")

    run_to_parquet(query(), out, ck)
    first = spark.read.parquet(out).count()
    ev.where(F.col("event_id") > mid).repartitionByRange(2, "event_id").write.mode("append").parquet(land)
    run_to_parquet(query(), out, ck)
    got = spark.read.parquet(out)
    assert got.count() > first
    single = run_to_memory(ops.window_count(read_replay(spark, land, ev.schema, files_per_trigger=1), "event_type",
                                            "ts", "6 hours", delay="1 hour"), "append", os.path.join(scratch, "ck_single"))
    cols = ["event_type", "window_start", "window_end", "cnt"]
    assert rows_set(got, *cols) == rows_set(single, *cols)


def test_text_csv_sources(spark, scratch):
    from tideline.sources import codec, files
    rows = [("Mary", "./home", 1000), ("Bob", "./cart", 2000)]
    p = os.path.join(scratch, "clicks_csv")
    spark.createDataFrame(rows, "users string, urls string, ms long").coalesce(1).write.csv(p)
    assert rows_set(files.read_csv(spark, p), "users", "urls", "ms") == sorted(rows)
    s = files.read_csv(spark, p, stream=True)
    got = run_to_memory(s, "append", os.path.join(scratch, "ck"))
    assert rows_set(got, "users", "urls", "ms") == sorted(rows)
    lines = files.read_lines(spark, p)
    parsed = codec.parse_delimited(lines, "value", [("users", "string"), ("urls", "string"), ("ms", "bigint")])
    assert rows_set(parsed, "users", "ms", "route") == [("Bob", 2000, "main"), ("Mary", 1000, "main")]


def _poll(spark, table, want_rows, seconds=60):
    import time
    deadline = time.time() + seconds
    while time.time() < deadline:
        try:
            if spark.table(table).count() >= want_rows:
                return
        except Exception:  # noqa: BLE001 - table appears after the first batch
            pass
        time.sleep(1)


def test_processing_time_operators(spark, scratch):
    """O-43 processing-time window, O-74 processing-time timers and O-77 TTL
    state: wall-clock dependent, so only row-level facts are checked; runs
    with a short trigger, a bounded wait and an explicit stop."""
    from tideline.functions.time import epoch_ms
    s = _stream_batches(spark, [F12[:4], F12[4:]], EV, scratch)
    q = (ops.processing_time_window_count(s, "users", "10 seconds").writeStream.format("memory")
         .queryName("pt_windows").outputMode("update").option("checkpointLocation", os.path.join(scratch, "ck1"))
         .trigger(processingTime="500 milliseconds").start())
    try:
        _poll(spark, "pt_windows", 1, 60)
    finally:
        q.stop()
    assert spark.table("pt_windows").count() >= 1

    s2 = _stream_batches(spark, [F12[:2]], EV, scratch, "pt2").select(
        F.col("users").alias("k"), epoch_ms("ts").alias("ms"))
    q2 = (s2.groupBy("k").transformWithState(stateful.ProcessingTimeTimer(1000), "k string, timer_ms long",
                                              "Append", "ProcessingTime")
          .writeStream.format("memory").queryName("pt_timers").outputMode("append")
          .option("checkpointLocation", os.path.join(scratch, "ck2")).trigger(processingTime="500 milliseconds")
          .start())
    try:
        _poll(spark, "pt_timers", 2, 60)
    finally:
        q2.stop()
    assert sorted(r.k for r in spark.table("pt_timers").collect()) == ["Alice", "Bob"]

    s3 = _stream_batches(spark, [[("a", "x", 1)], [("a", "y", 2)]], EV, scratch, "ttl").select(
        F.col("users").alias("k"), F.col("urls").alias("sym"))
    q3 = (s3.groupBy("k").transformWithState(stateful.LastSeenTTL(3_600_000), "k string, previous string, current string",
                                              "Append", "ProcessingTime")
          .writeStream.format("memory").queryName("ttl_out").outputMode("append")
          .option("checkpointLocation", os.path.join(scratch, "ck3")).trigger(processingTime="500 milliseconds")
          .start())
    try:
        _poll(spark, "ttl_out", 2, 60)
    finally:
        q3.stop()
    got = sorted((r.previous or "", r.current) for r in spark.table("ttl_out").collect())
    assert got == [("", "x"), ("x", "y")]


def test_keep_last_and_lateness_stream(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events")
    folder = replay_to_files(ev, scratch, 4, "event_id")[0]
    max_ts = ev.agg(F.max("ts")).first()[0]
    s = read_replay(spark, folder, ev.schema)
    kl = run_to_memory(stateful.keep_last_stream(s, "event_type", "ts", "value", "event_id", "1 day", 10), "append",
                       os.path.join(scratch, "ck1"))
    b = windows.keep_last(ev, "event_type", "ts", "1 day", 10, "value", tiebreak="event_id").where(
        F.col("window_end") <= F.lit(max_ts))
    b = b.withColumn("window_start_ms", F.floor(epoch_us("window_start") / 1000).cast("bigint"))
    assert rows_set(kl.withColumnRenamed("k", "event_type").withColumn("total", F.round("total", 6)),
                    "event_type", "window_start_ms", "cnt", "total") == \
        rows_set(b.withColumn("total", F.round("total", 6)), "event_type", "window_start_ms", "cnt", "total")

    s = read_replay(spark, folder, ev.schema)
    up = run_to_memory(ops.window_count_with_lateness(s, "event_type", "ts", "6 hours", "5 minutes", "1 hour"),
                       "update", os.path.join(scratch, "ck2"))
    last = up.groupBy("event_type", "window_start").agg(F.max("cnt").alias("cnt"))
    full = windows.tumbling_count(ev, "event_type", "ts", "6 hours")
    assert rows_set(last, "event_type", "window_start", "cnt") == rows_set(full, "event_type", "window_start", "cnt")
