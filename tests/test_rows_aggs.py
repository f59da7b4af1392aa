import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL, frame, rows_set
from tideline.operators import aggs, layout, route, rows
from tideline.operators.sequence import keyed_neighbours, keyed_seq, running_aggregates
from tideline.sources import codec
from tideline.sources.tables import read_table

F1 = [("Mary", "./home", 1000), ("Bob", "./cart", 2000)]
EV = "users string, urls string, ms long"
F13 = [("Alice", "./home", 1000), ("Bob", "./cart", 1000), ("Alice", "./prod?id=1", 5000),
       ("Cary", "./home", 60000), ("Bob", "./prod?id=3", 90000), ("Alice", "./prod?id=7", 105000)]


def test_filter_flatmap_process(spark):
    df = frame(spark, F1, EV)
    assert rows_set(rows.filter_eq(df, "users", "Mary"), "users", "urls") == [("Mary", "./home")]
    fm = rows.flat_map_by_rule(df, F.col("users") == "Mary", ["users"], ["users", "urls"])
    assert sorted(r.value for r in fm.collect()) == sorted(["Mary", "Bob", "./cart"])
    n = F.when(F.col("users") == "Mary", 1).when(F.col("users") == "Bob", 2).otherwise(0)
    assert sorted(r.value for r in rows.emit_n(df, "users", n).collect()) == ["Bob", "Bob", "Mary"]


def test_keyed_aggs_golden(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("b", 4)], "f0 string, f1 int").withColumn(
        "seq", F.monotonically_increasing_id())
    s = aggs.keyed_sum_min_max(df, "f0", "f1")
    assert rows_set(s, "f0", "sum_value", "min_value", "max_value") == [("a", 4, 1, 3), ("b", 6, 2, 4)]
    mb = aggs.keyed_min_max_by(df, "f0", "f1", "seq", ["f0", "f1"])
    assert rows_set(mb, "f0", "min_f1", "max_f1") == [("a", 1, 3), ("b", 2, 4)]


def test_running_min_by_golden(spark):
    df = frame(spark, [("a", 1, 1000), ("a", 3, 2000), ("b", 2, 3000), ("b", 4, 4000)], "f0 string, f1 int, ms long")
    out = aggs.running_min_by(df, "f0", "ts", "f1", "ms", ["f0", "f1"], slot="1 second", target_rows=1)
    assert rows_set(out, "min_f0", "min_f1") == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]


def test_custom_partition_golden(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 9)], "id int")
    out = layout.with_partition_id(layout.partition_custom(df, 2, F.col("id")))
    got = {r.id: r.pid for r in out.collect()}
    assert {k for k, v in got.items() if v == 0} == {2, 4, 6, 8}
    assert {k for k, v in got.items() if v == 1} == {1, 3, 5, 7}


def test_comap_and_routes(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "i int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "l long")
    both = route.connect(a, b)
    out = both.select(F.when(F.col("side") == "left", F.concat(F.lit("Integer: "), F.col("i").cast("string")))
                      .otherwise(F.concat(F.lit("Long: "), F.col("l").cast("string"))).alias("v"))
    assert sorted(r.v for r in out.collect()) == sorted([f"Integer: {i}" for i in (1, 2, 3)] + [f"Long: {i}" for i in (1, 2, 3)])
    df = frame(spark, F13, EV)
    parts = route.split(df, [("mary", F.col("users") == "Mary"), ("bob", F.col("users") == "Bob")], "else")
    assert parts["bob"].count() == 2 and parts["else"].count() == 4 and parts["mary"].count() == 0


def test_sql_and_changelog_golden(spark):
    df = frame(spark, F13, EV).withColumn("seq", F.monotonically_increasing_id())
    df.createOrReplaceTempView("clicks_f13")
    assert spark.sql("SELECT urls, users FROM clicks_f13").count() == 6
    assert spark.sql("SELECT * FROM clicks_f13 WHERE users = 'Alice'").count() == 3
    assert rows_set(aggs.group_count(df, "users", "urls"), "users", "cnt") == [("Alice", 3), ("Bob", 2), ("Cary", 1)]
    ch = aggs.changelog_count(df, "users", "ts", tiebreak="seq", slot="10 seconds", target_rows=1)
    got = [(r.op, r.users, r.cnt) for r in ch.orderBy("ts", "seq", "op_order").collect()]
    assert got == [("+I", "Alice", 1), ("+I", "Bob", 1), ("-U", "Alice", 1), ("+U", "Alice", 2), ("+I", "Cary", 1),
                   ("-U", "Bob", 1), ("+U", "Bob", 2), ("-U", "Alice", 2), ("+U", "Alice", 3)]


def test_parse_and_encode(spark):
    lines = spark.createDataFrame([("Mary, ./home, 1000",), ("bad line",), ("Bob, ./cart, x",)], "line string")
    out = codec.parse_delimited(lines, "line", [("users", "string"), ("urls", "string"), ("ms", "bigint")])
    got = sorted((r.users, r.ms, r.route) for r in out.collect())
    assert ("Mary", 1000, "main") in got and sum(1 for g in got if g[2] == "bad") == 2
    enc = codec.encode_event(frame(spark, F1[:1], EV), "users", "urls", "ts")
    assert enc.first().line == "Event{users='Mary', urls='./home', timestamp=1970-01-01 00:00:01.000}"


def _brute_seq(pdf, key, ts, tb):
    pdf = pdf.sort_values([key, ts, tb]).copy()
    pdf["seq_b"] = pdf.groupby(key).cumcount() + 1
    return pdf


def test_keyed_seq_matches_bruteforce_any_bucket(spark):
    ev = read_table(spark, SF_SMALL, "events").select("event_id", "user_id", "ts", "value", "event_type")
    brute = _brute_seq(ev.toPandas(), "user_id", "ts", "event_id")
    want = dict(zip(brute.event_id, brute.seq_b))
    for bucket, hot in [("1 hour", None), ("1 day", 5), ("30 days", None), ("1 day", 10**9)]:
        got = {r.event_id: r.seq for r in keyed_seq(ev, "user_id", "ts", "event_id", bucket, target_rows=hot).collect()}
        assert got == want
        nb = keyed_neighbours(ev, "user_id", "ts", ["event_type"], [1, 2, -1], tiebreak="event_id", slot=bucket,
                              target_rows=hot)
        b = brute.sort_values(["user_id", "seq_b"])
        g = b.groupby("user_id")["event_type"]
        exp = pd.DataFrame({"event_id": b.event_id, "n1": g.shift(-1), "n2": g.shift(-2), "p1": g.shift(1)})
        exp = {r.event_id: (r.n1 if isinstance(r.n1, str) else None, r.n2 if isinstance(r.n2, str) else None,
                            r.p1 if isinstance(r.p1, str) else None) for r in exp.itertuples()}
        got = {r.event_id: (r.event_type_next1, r.event_type_next2, r.event_type_prev1) for r in nb.collect()}
        assert got == exp
        ra = running_aggregates(ev, "user_id", "ts", "value", tiebreak="event_id", slot=bucket, target_rows=hot)
        rc = {r.event_id: r.running_count for r in ra.collect()}
        assert rc == want


def test_count_windows(spark):
    rows_ = [("a", "x", i * 1000) for i in range(1, 8)]
    df = frame(spark, rows_, EV).withColumn("v", F.lit(1))
    tum = aggs.count_window_tumbling(df, "users", "ts", 3, "v", slot="2 seconds", target_rows=1)
    assert rows_set(tum, "block", "cnt") == [(0, 3), (1, 3)]
    sl = aggs.count_window_sliding(df, "users", "ts", 5, 2, "v", slot="2 seconds", target_rows=1)
    assert rows_set(sl, "fire_seq", "cnt") == [(2, 2), (4, 4), (6, 5)]


def test_first_n_average(spark):
    df = frame(spark, [("u", "x", 1000 * i) for i in range(1, 8)] + [("v", "x", 5)], EV)
    out = aggs.first_n_average_ms(df, "urls", "ts", 5)
    assert rows_set(out, "urls", "avg_ms") == [("x", (5 + 1000 + 2000 + 3000 + 4000) // 5)]
    rep = aggs.every_n_average_ms(df.where(F.col("users") == "u"), "users", "ts", 3, slot="2 seconds",
                                  target_rows=1)
    assert rows_set(rep, "block", "avg_ms") == [(0, 2000), (1, 5000)]


def test_rich_map_and_udaf(spark):
    ev = read_table(spark, SF_SMALL, "events")
    calls = []

    def op():
        return {"k": 2}

    def mp(res, b):
        return pd.DataFrame({"event_id": b["event_id"] * res["k"]})

    out = rows.rich_map(ev.select("event_id"), op, mp, lambda r: calls.append(1), "event_id long")
    assert out.agg(F.sum("event_id")).first()[0] == 2 * ev.agg(F.sum("event_id")).first()[0]
    m = {r.event_type: r.m for r in rows.user_aggregate(ev.repartition(5), "event_type", ["value"], rows.MeanOf("value"), "double", "m").collect()}
    a = {r.event_type: r.a for r in ev.groupBy("event_type").agg(F.avg("value").alias("a")).collect()}
    assert m.keys() == a.keys() and all(abs(m[k] - a[k]) < 1e-9 for k in m)
