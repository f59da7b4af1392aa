"""Streaming forms checked against the same DuckDB oracle as the batch ones.

Each query replays ``events`` in event-id order as a file stream (4 parts,
one per micro-batch), runs the streaming operator to completion
(``availableNow``) into a parquet sink under the session's shared
checkpoint folder, and returns that output.  The oracle SQL carries the
end-of-input rule: only windows / timers the final watermark has passed
(``<= max(ts) - delay``) are emitted."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tideline.operators import windows
from tideline.plans.event_patterns import LOGIN_FAIL_TRANSITIONS
from tideline.plans.registry import register
from tideline.session import checkpoint_dir
from tideline.sources.tables import read_table
from tideline.sources import files
from tideline.streaming import feeds, ops, sinks, stateful, timers, topn
from tideline.streaming.replay import replay, run_to_parquet

_EPOCH = "TIMESTAMP '1970-01-01'"


def _run(spark, sf_dir, name, build, cols=("event_id", "ts", "user_id", "event_type"), displaced=False, empty_batches=True):
    """``displaced``: rows arrive up to ten positions early or late, across the cuts between micro-batches."""
    base = os.path.join(checkpoint_dir(spark), "tideline-streams", f"{name}-{uuid.uuid4().hex[:8]}")
    ev = read_table(spark, sf_dir, "events").select(*cols)
    if displaced:
        ev = ev.withColumn("arrival", F.col("event_id") + F.col("event_id") * 7919 % 21 - 10)
    stream = replay(ev, base, 4, "arrival" if displaced else "event_id")
    out = os.path.join(base, "out")
    run_to_parquet(build(stream), out, os.path.join(base, "ck"), empty_batches)
    return spark.read.parquet(out)


@register("stream_window_counts", f"""
SELECT event_type, window_start, window_end, count(*) AS cnt
FROM (SELECT event_type, time_bucket(INTERVAL '6 hours', ts, {_EPOCH}) AS window_start,
             time_bucket(INTERVAL '6 hours', ts, {_EPOCH}) + INTERVAL '6 hours' AS window_end FROM events)
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '1 hour'
GROUP BY ALL
""")
def stream_window_counts(spark, sf_dir):
    """O-38 / O-61 on a stream: 6 h tumbling counts per type, 1 h out-of-orderness."""
    return _run(spark, sf_dir, "window_counts",
                lambda s: ops.window_count(s, "event_type", "ts", "6 hours", delay="1 hour"))


@register("stream_cumulative_windows", f"""
WITH p AS (
  SELECT event_type, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w,
         CAST(floor(epoch_us(ts - time_bucket(INTERVAL '1 day', ts, {_EPOCH})) / 21600000000) AS INTEGER) AS i
  FROM events)
SELECT event_type, w AS window_start, w + INTERVAL '6 hours' * (j + 1) AS window_end, count(*) AS cnt
FROM (SELECT event_type, w, unnest(range(i, 4)) AS j FROM p)
WHERE w + INTERVAL '1 day' <= (SELECT max(ts) FROM events)
GROUP BY ALL
""")
def stream_cumulative(spark, sf_dir):
    """O-55 on a stream (monotone watermark): a cumulate window group closes
    with its max-size window."""
    return _run(spark, sf_dir, "cumulative",
                lambda s: ops.cumulative_count(s, "event_type", "ts", "6 hours", "1 day"))


@register("stream_interval_join", """
SELECT p.user_id AS user_id, p.event_id AS l_event_id, c.event_id AS r_event_id
FROM events p JOIN events c
  ON p.user_id = c.user_id AND c.ts BETWEEN p.ts - INTERVAL '5 hours' AND p.ts + INTERVAL '10 hours'
WHERE p.event_type = 'purchase' AND c.event_type = 'click'
""")
def stream_interval_join(spark, sf_dir):
    """O-67 stream-stream with watermarks on both sides (state is bounded)."""
    def build(s):
        buys = s.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
        clicks = s.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
        j = ops.interval_join(buys, clicks, "user_id", "ts", "ts", "-5 hours", "10 hours", delay="10 hours")
        return j.select(F.col("l_user_id").alias("user_id"), "l_event_id", "r_event_id")
    return _run(spark, sf_dir, "interval_join", build)


@register("stream_periodic_pv", """
WITH RECURSIVE chain(user_id, fire) AS (
  SELECT user_id, min(ts) + INTERVAL '10 hours' FROM events GROUP BY user_id
  UNION ALL
  SELECT c.user_id, n.nt + INTERVAL '10 hours'
  FROM chain c, LATERAL (SELECT min(ts) AS nt FROM events e WHERE e.user_id = c.user_id AND e.ts > c.fire) n
  WHERE n.nt IS NOT NULL)
SELECT user_id, CAST(epoch_us(fire) // 1000 AS BIGINT) AS fire_ms,
       (SELECT count(*) FROM events e WHERE e.user_id = chain.user_id AND e.ts <= chain.fire) AS cnt
FROM chain WHERE epoch_us(fire) // 1000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events)
""")
def stream_periodic_pv(spark, sf_dir):
    """O-76 with transformWithState: value states + event-time timer."""
    out = _run(spark, sf_dir, "periodic_pv", lambda s: stateful.periodic_count_stream(s, "user_id", "ts", "10 hours"))
    return out.select(F.col("k").alias("user_id"), "fire_ms", "cnt")


@register("stream_order_timeout", """
WITH b AS (
  SELECT s.user_id, s.event_id AS start_id, s.ts AS start_ts,
         CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN p.event_id END AS end_id,
         CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN 'matched' ELSE 'timeout' END AS status
  FROM events s
  LEFT JOIN LATERAL (SELECT event_id, ts FROM events e
                     WHERE e.user_id = s.user_id AND e.event_type = 'purchase' AND (e.ts, e.event_id) > (s.ts, s.event_id)
                     ORDER BY e.ts, e.event_id LIMIT 1) p ON true
  WHERE s.event_type = 'signup')
SELECT user_id, start_id, end_id, status FROM b
WHERE status = 'matched'
   OR epoch_us(start_ts) // 1000 + 86400000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events)
""")
def stream_order_timeout(spark, sf_dir):
    """O-79 with transformWithState: waiting starts in list state, one timer
    per start; timeouts come out once the watermark passes start + 1 day."""
    out = _run(spark, sf_dir, "order_timeout", lambda s: stateful.followed_by_stream(
        s, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", "1 day", "event_id"))
    return out.select(F.col("k").alias("user_id"), "start_id", "end_id", "status")


@register("stream_changelog", """
WITH s AS (SELECT user_id, event_id,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events)
SELECT user_id, event_id, '+I' AS op, seq AS cnt FROM s WHERE seq = 1
UNION ALL SELECT user_id, event_id, '-U', seq - 1 FROM s WHERE seq > 1
UNION ALL SELECT user_id, event_id, '+U', seq FROM s WHERE seq > 1
""")
def stream_changelog(spark, sf_dir):
    """O-57 with transformWithState: both images of every update."""
    out = _run(spark, sf_dir, "changelog", lambda s: stateful.changelog_stream(s, "user_id", "ts", "event_id"))
    return out.select(F.col("k").alias("user_id"), F.col("tb").alias("event_id"), "op", "cnt")


@register("stream_state_machine", """
SELECT user_id, event_id FROM (
  SELECT user_id, event_id, event_type = 'error' AND lag(event_type, 1) OVER w = 'error'
                            AND lag(event_type, 2) OVER w = 'error' AS hit
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE hit
""")
def stream_state_machine(spark, sf_dir):
    """O-80 with transformWithState: the transition table per user."""
    out = _run(spark, sf_dir, "state_machine", lambda s: stateful.state_machine_stream(
        s, "user_id", "ts", "event_type", "event_id", LOGIN_FAIL_TRANSITIONS, "Initial", "Matched", "Terminal"))
    return out.select(F.col("k").alias("user_id"), F.col("tb").alias("event_id"))


@register("stream_event_time_timers", """
SELECT user_id, epoch_us(ts) // 1000 + 36000000 AS timer_ms FROM events
WHERE epoch_us(ts) // 1000 + 36000000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events)
GROUP BY ALL
""")
def stream_timers(spark, sf_dir):
    """O-73: a 10 h event-time timer per event; each fires once the watermark passes."""
    out = _run(spark, sf_dir, "timers", lambda s: stateful.event_time_timers(s, "user_id", "ts", "10 hours"))
    return out.select(F.col("k").alias("user_id"), "timer_ms")




_SEEN = "epoch_us(ts) // 3600000000 * 3600000000 + 3600000000 <= (SELECT epoch_us(max(ts)) FROM events) - 172800000000"


@register("stream_strict_out_of_order", f"""
SELECT user_id, event_id FROM (
  SELECT user_id, event_id, event_type = 'error' AND lag(event_type, 1) OVER w = 'error'
                            AND lag(event_type, 2) OVER w = 'error' AS hit
  FROM events WHERE {_SEEN} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE hit
""")
def stream_strict_out_of_order(spark, sf_dir):
    """O-78 with rows out of order: held until the watermark (2 days behind) has passed their hour."""
    e = F.col("event_type") == "error"
    out = _run(spark, sf_dir, "strict_ooo", lambda s: stateful.strict_sequence_stream(
        s, "user_id", "ts", "event_id", [e, e, e], delay="2 days", slot="1 hour"), displaced=True)
    return out.select(F.col("k").alias("user_id"), F.element_at("ids", 3).alias("event_id"))


@register("stream_state_machine_out_of_order", f"""
SELECT user_id, event_id FROM (
  SELECT user_id, event_id, event_type = 'error' AND lag(event_type, 1) OVER w = 'error'
                            AND lag(event_type, 2) OVER w = 'error' AS hit
  FROM events WHERE {_SEEN} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE hit
""")
def stream_state_machine_out_of_order(spark, sf_dir):
    """O-80 with rows out of order."""
    out = _run(spark, sf_dir, "machine_ooo", lambda s: stateful.state_machine_stream(
        s, "user_id", "ts", "event_type", "event_id", LOGIN_FAIL_TRANSITIONS, "Initial", "Matched", "Terminal",
        delay="2 days", slot="1 hour"), displaced=True)
    return out.select(F.col("k").alias("user_id"), F.col("tb").alias("event_id"))


@register("stream_order_timeout_out_of_order", """
WITH seen AS (SELECT * FROM events WHERE epoch_us(ts) // 1000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - 172800000),
b AS (
  SELECT s.user_id, s.event_id AS start_id, s.ts AS start_ts,
         CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN p.event_id END AS end_id,
         CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN 'matched' ELSE 'timeout' END AS status
  FROM seen s
  LEFT JOIN LATERAL (SELECT event_id, ts FROM seen e
                     WHERE e.user_id = s.user_id AND e.event_type = 'purchase' AND (e.ts, e.event_id) > (s.ts, s.event_id)
                     ORDER BY e.ts, e.event_id LIMIT 1) p ON true
  WHERE s.event_type = 'signup')
SELECT user_id, start_id, end_id, status FROM b
WHERE status = 'matched'
   OR epoch_us(start_ts) // 1000 + 86400000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - 172800000
""")
def stream_order_timeout_out_of_order(spark, sf_dir):
    """O-79 with rows out of order: an end row that arrives before its start still matches it, never one after it."""
    out = _run(spark, sf_dir, "timeout_ooo", lambda s: stateful.followed_by_stream(
        s, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", "1 day", "event_id", delay="2 days"), displaced=True)
    return out.select(F.col("k").alias("user_id"), "start_id", "end_id", "status")


@register("stream_periodic_pv_out_of_order", """
WITH RECURSIVE chain(user_id, fire) AS (
  SELECT user_id, min(ts) + INTERVAL '10 hours' FROM events GROUP BY user_id
  UNION ALL
  SELECT c.user_id, n.nt + INTERVAL '10 hours'
  FROM chain c, LATERAL (SELECT min(ts) AS nt FROM events e WHERE e.user_id = c.user_id AND e.ts > c.fire) n
  WHERE n.nt IS NOT NULL)
SELECT user_id, CAST(epoch_us(fire) // 1000 AS BIGINT) AS fire_ms,
       (SELECT count(*) FROM events e WHERE e.user_id = chain.user_id AND e.ts <= chain.fire) AS cnt
FROM chain WHERE epoch_us(fire) // 1000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - 172800000
""")
def stream_periodic_pv_out_of_order(spark, sf_dir):
    """O-76 with rows out of order: the same firings as in time order."""
    out = _run(spark, sf_dir, "periodic_ooo", lambda s: stateful.periodic_count_stream(s, "user_id", "ts", "10 hours", delay="2 days"), displaced=True)
    return out.select(F.col("k").alias("user_id"), "fire_ms", "cnt")


def _through_sink(spark, sf_dir, name, sink):
    """``events`` as a stream through ``sink(stream, out, checkpoint)``, and what it wrote."""
    base = os.path.join(checkpoint_dir(spark), "tideline-streams", f"{name}-{uuid.uuid4().hex[:8]}")
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    q = sink(replay(ev, base, 4, "event_id"), os.path.join(base, "out"), os.path.join(base, "ck"))
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out"))


@register("stream_rolling_files", "SELECT event_id, user_id, event_type FROM events")
def stream_rolling_files(spark, sf_dir):
    """O-07: files rolled at 500 records, read back."""
    return _through_sink(spark, sf_dir, "rolling", lambda s, out, ck: sinks.rolling_file_sink(
        s, out, ck, max_records_per_file=500, available_now=True))


@register("stream_side_outputs", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'paid' WHEN event_type = 'error' THEN 'alert' ELSE 'main' END AS route
FROM events
""")
def stream_side_outputs(spark, sf_dir):
    """O-28 on a stream: all routes in one pass."""
    rules = [("paid", F.col("event_type") == "purchase"), ("alert", F.col("event_type") == "error")]
    out = _through_sink(spark, sf_dir, "routes", lambda s, out, ck: sinks.side_outputs_sink(s, rules, out, ck, available_now=True))
    return out.select("event_id", "route")


@register("stream_two_feeds", """
WITH l AS (SELECT event_id // 2 AS k, event_id AS id, epoch_us(ts) // 1000 AS ms FROM events WHERE event_id % 2 = 0),
r AS (SELECT event_id // 2 AS k, event_id AS id, epoch_us(ts) // 1000 AS ms FROM events WHERE event_id % 2 = 1),
w AS (SELECT epoch_us(max(ts)) // 1000 AS ms FROM events)
SELECT l.k, l.id AS l_id, r.id AS r_id, 'matched' AS status FROM l JOIN r ON l.k = r.k AND abs(l.ms - r.ms) <= 300000
UNION ALL SELECT l.k, l.id, NULL, 'right_missing' FROM l LEFT JOIN r ON l.k = r.k AND abs(l.ms - r.ms) <= 300000
WHERE r.k IS NULL AND l.ms + 300000 < (SELECT ms FROM w)
UNION ALL SELECT r.k, NULL, r.id, 'left_missing' FROM r LEFT JOIN l ON l.k = r.k AND abs(l.ms - r.ms) <= 300000
WHERE l.k IS NULL AND r.ms + 300000 < (SELECT ms FROM w)
""")
def stream_two_feeds(spark, sf_dir):
    """O-31: even and odd events as two feeds, paired within 5 minutes by shared state, timers and their deletion."""
    def build(s):
        s = s.withColumn("k", F.expr("event_id div 2"))
        sides = [s.where(F.col("event_id") % 2 == i).select("k", "ts", "event_id") for i in (0, 1)]
        return feeds.two_feeds_stream(*sides, "k", "ts", "event_id", "5 minutes")
    return _run(spark, sf_dir, "two_feeds", build)


_RECONCILED = """
WITH l AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'click'),
r AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms FROM events WHERE event_type = 'purchase'),
w AS (SELECT greatest((SELECT max(ms) FROM l), (SELECT max(ms) FROM r)) - 172800000 AS ms),
p AS (SELECT l.user_id, l.event_id AS l_id, r.event_id AS r_id FROM l JOIN r ON l.user_id = r.user_id AND abs(l.ms - r.ms) <= 86400000)
SELECT user_id, l_id, r_id, 'matched' AS status FROM p
UNION ALL SELECT user_id, event_id, NULL, 'right_missing' FROM l WHERE event_id NOT IN (SELECT l_id FROM p) AND ms + 86400000 < (SELECT ms FROM w)
UNION ALL SELECT user_id, NULL, event_id, 'left_missing' FROM r WHERE event_id NOT IN (SELECT r_id FROM p) AND ms + 86400000 < (SELECT ms FROM w)
"""


def _clicks_and_purchases(s):
    return [s.where(F.col("event_type") == t).select("event_id", "user_id", "ts") for t in ("click", "purchase")]


@register("stream_two_feeds_out_of_order", _RECONCILED)
def stream_two_feeds_out_of_order(spark, sf_dir):
    """O-31 / O-46 with many rows per key and side, out of order: all pairs within a day, each miss once."""
    out = _run(spark, sf_dir, "two_feeds_ooo", lambda s: feeds.two_feeds_stream(
        *_clicks_and_purchases(s), "user_id", "ts", "event_id", "1 day", delay="2 days"), displaced=True)
    return out.withColumnRenamed("k", "user_id")


@register("stream_reconcile_join", _RECONCILED)
def stream_reconcile_join(spark, sf_dir):
    """O-46 as a full outer stream-stream join: the same rows."""
    def build(s):
        j = ops.reconcile(*_clicks_and_purchases(s), "user_id", "ts", "ts", "1 day", delay="2 days")
        return j.select(F.coalesce("l_user_id", "r_user_id").alias("user_id"), F.col("l_event_id").alias("l_id"), F.col("r_event_id").alias("r_id"), "status")
    return _run(spark, sf_dir, "reconcile_join", build, displaced=True)


@register("stream_first5_average", """
SELECT user_id, CAST(sum(ms) // 5 AS BIGINT) AS avg_ms FROM (
  SELECT user_id, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE epoch_us(ts) // 3600000000 * 3600000000 + 3600000000 <= (SELECT epoch_us(max(ts)) FROM events) - 172800000000)
WHERE rn <= 5 GROUP BY user_id HAVING count(*) = 5
""")
def stream_first5_average(spark, sf_dir):
    """O-37 on a stream: the first five in event time, whatever the order of arrival."""
    out = _run(spark, sf_dir, "first5", lambda s: stateful.first_n_average_stream(
        s, "user_id", "ts", "event_id", 5, delay="2 days", slot="1 hour"), displaced=True)
    return out.withColumnRenamed("k", "user_id")


@register("stream_keep_last", """
SELECT user_id, w AS window_start_ms, count(*) AS cnt, round(sum(value), 6) AS total FROM (
  SELECT user_id, value, epoch_us(ts) // 1000 // 172800000 * 172800000 AS w,
         row_number() OVER (PARTITION BY user_id, epoch_us(ts) // 1000 // 172800000 ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= 3 AND w + 172800000 <= (SELECT epoch_us(max(ts)) // 1000 FROM events) - 172800000 GROUP BY user_id, w
""")
def stream_keep_last(spark, sf_dir):
    """O-52 on a stream: the last three rows of each user's two-day window."""
    out = _run(spark, sf_dir, "keep_last", lambda s: stateful.keep_last_stream(
        s, "user_id", "ts", "value", "event_id", "2 days", 3, delay="2 days"), cols=("event_id", "ts", "user_id", "value"), displaced=True)
    return out.select(F.col("k").alias("user_id"), "window_start_ms", "cnt", F.round("total", 6).alias("total"))


@register("text_and_csv_read_back", """
SELECT event_id, user_id, event_type, 'csv' AS source FROM events UNION ALL SELECT event_id, user_id, event_type, 'text' FROM events
""")
def text_and_csv(spark, sf_dir):
    """O-02: the table written as CSV files and as text lines, read back by the file sources."""
    base = os.path.join(checkpoint_dir(spark), "tideline-files", uuid.uuid4().hex[:8])
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    ev.write.csv(base + "/csv")
    ev.select(F.concat_ws(";", *ev.columns)).write.text(base + "/text")
    schema = "event_id bigint, user_id bigint, event_type string"
    parts = F.split("value", ";")
    lines = files.read_lines(spark, base + "/text").select(parts[0].cast("bigint").alias("event_id"), parts[1].cast("bigint").alias("user_id"), parts[2].alias("event_type"))
    return files.read_csv(spark, base + "/csv", schema).withColumn("source", F.lit("csv")).unionByName(lines.withColumn("source", F.lit("text")))


_CLOSED = "(SELECT max(ts) FROM events) - INTERVAL '1 hour'"


@register("stream_distinct_users", f"""
SELECT w AS window_start, w + INTERVAL '1 day' AS window_end, count(*) AS pv, count(DISTINCT user_id) AS uv,
       round(count(*) / count(DISTINCT user_id), 6) AS pv_per_uv
FROM (SELECT time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w, user_id FROM events)
WHERE w + INTERVAL '1 day' <= {_CLOSED} GROUP BY w
""")
def stream_distinct_users(spark, sf_dir):
    """O-41 / O-42 on a stream: chained aggregations."""
    return _run(spark, sf_dir, "distinct", lambda s: ops.distinct_count(s, "user_id", "ts", "1 day", delay="1 hour"))


@register("stream_sessions", f"""
WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL '12 hours' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '12 hours' AS session_end, count(*) AS cnt
FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL '12 hours' <= {_CLOSED}
""")
def stream_sessions(spark, sf_dir):
    """O-44 on a stream: sessions that the watermark has closed."""
    return _run(spark, sf_dir, "sessions", lambda s: ops.session_count(s, "user_id", "ts", "12 hours", delay="1 hour"))


@register("stream_top2_event_types", f"""
WITH c AS (SELECT event_type, time_bucket(INTERVAL '6 hours', ts, {_EPOCH}) AS w, count(*) AS cnt FROM events GROUP BY ALL)
SELECT w AS window_start, w + INTERVAL '6 hours' AS window_end, event_type, cnt, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY cnt DESC, event_type) AS rn FROM c)
WHERE rn <= 2 AND w + INTERVAL '6 hours' <= {_CLOSED}
""")
def stream_top2(spark, sf_dir):
    """O-70 on a stream: counts, then the two largest of each window."""
    return _run(spark, sf_dir, "top2", lambda s: topn.windowed_top_n(s, "event_type", "ts", "6 hours", None, 2, delay="1 hour"))


@register("stream_top3_users", f"""
WITH c AS (SELECT user_id, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) - i * INTERVAL '1 day' AS w, count(*) AS cnt
           FROM events, (SELECT unnest([0, 1]) AS i) GROUP BY ALL)
SELECT w AS window_start, w + INTERVAL '2 days' AS window_end, user_id, cnt, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY w ORDER BY cnt DESC, user_id) AS rn FROM c)
WHERE rn <= 3 AND w + INTERVAL '2 days' <= {_CLOSED}
""")
def stream_top3_users(spark, sf_dir):
    """O-71 on a stream: the three busiest users of sliding windows, at most 3 * 8 candidates a window."""
    return _run(spark, sf_dir, "top3", lambda s: topn.windowed_top_n(s, "user_id", "ts", "2 days", "1 day", 3, delay="1 hour", buckets=8))


@register("stream_window_join", f"""
WITH e AS (SELECT *, time_bucket(INTERVAL '6 hours', ts, {_EPOCH}) AS w FROM events)
SELECT p.user_id AS user_id, p.event_id AS l_event_id, c.event_id AS r_event_id, p.w AS window_start
FROM e p JOIN e c ON p.user_id = c.user_id AND p.w = c.w WHERE p.event_type = 'purchase' AND c.event_type = 'click'
""")
def stream_window_join(spark, sf_dir):
    """O-65 on a stream: purchases and clicks of a user in the same 6 h."""
    def build(s):
        sides = [s.where(F.col("event_type") == t).select("event_id", "user_id", "ts") for t in ("purchase", "click")]
        j = ops.window_join(*sides, "user_id", "ts", "ts", "6 hours", delay="10 hours")
        return j.select(F.col("l_user_id").alias("user_id"), "l_event_id", "r_event_id", "window_start")
    return _run(spark, sf_dir, "window_join", build)


@register("stream_rule_matches", """
SELECT user_id, event_id, prev_action, action FROM (
  SELECT user_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_action, event_type AS action FROM events)
WHERE (prev_action, action) IN (('view', 'purchase'), ('error', 'error'))
""")
def stream_rule_matches(spark, sf_dir):
    """O-68 on a stream: previous action from state against a table of rules."""
    rules = spark.createDataFrame([("view", "purchase"), ("error", "error")], "action1 string, action2 string")
    out = _run(spark, sf_dir, "rules", lambda s: stateful.rule_matches_stream(s, "user_id", "ts", "event_type", "event_id", rules))
    return out.select(F.col("k").alias("user_id"), F.col("tb").alias("event_id"), "prev_action", "action")


@register("stream_uv_sketch", f"""
SELECT w AS window_start, w + INTERVAL '1 day' AS window_end, count(*) AS pv, true AS close
FROM (SELECT time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w, user_id FROM events)
WHERE w + INTERVAL '1 day' <= {_CLOSED} GROUP BY w
""")
def stream_uv_sketch(spark, sf_dir):
    """O-42 on a stream with one sketch a window, held against the exact count: ``close`` within four standard errors."""
    est = _run(spark, sf_dir, "uv_sketch", lambda s: ops.distinct_by_sketch(s, "user_id", "ts", "1 day", delay="1 hour"))
    exact = windows.distinct_count_window(read_table(spark, sf_dir, "events"), "user_id", "ts", "1 day").select("window_start", "uv")
    close = F.abs(F.col("uv_estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * (4 * windows.SKETCH_ERROR))
    return est.join(exact, "window_start").select("window_start", "window_end", "pv", close.alias("close"))


@register("stream_early_fire", f"""
WITH p AS (SELECT event_type, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w, ts FROM events)
SELECT event_type, w AS window_start, w + INTERVAL '1 day' AS window_end, w + j * INTERVAL '6 hours' AS fire_time, count(*) AS cnt
FROM p, (SELECT unnest(range(0, 5)) AS j)
WHERE ts <= w + j * INTERVAL '6 hours' AND w + INTERVAL '1 day' <= {_CLOSED} GROUP BY ALL
""")
def stream_early_fire(spark, sf_dir):
    """O-51 on a stream: counts every six hours inside a day's window."""
    return _run(spark, sf_dir, "early_fire", lambda s: ops.early_fire_count(s, "event_type", "ts", "1 day", "6 hours", delay="1 hour"))


@register("stream_debounce", """
WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events),
s AS (SELECT user_id, ms, CASE WHEN ms - lag(ms) OVER w < 21600000 THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms)),
g AS (SELECT user_id, ms, sum(fresh) OVER (PARTITION BY user_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS burst FROM s)
SELECT user_id, min(ms) AS first_ms, max(ms) + 21600000 AS fire_ms, count(*) AS cnt FROM g GROUP BY user_id, burst
HAVING max(ms) + 21600000 <= (SELECT max(ms) FROM e) - 86400000
""")
def stream_debounce(spark, sf_dir):
    """O-75: a user's bursts, told six quiet hours after their last event; rows arrive out of order."""
    out = _run(spark, sf_dir, "debounce", lambda s: timers.debounce_stream(s, "user_id", "ts", "6 hours", delay="1 day"), displaced=True)
    return out.select(F.col("k").alias("user_id"), "first_ms", "fire_ms", "cnt")


@register("stream_recently_seen", """
SELECT user_id, event_id, event_type, min(event_id) OVER (PARTITION BY user_id, event_type) AS first_id,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS recent_rows
FROM events
""")
def stream_recently_seen(spark, sf_dir):
    """O-77: map and list state with expiring entries; at a TTL of thirty days nothing expires while this runs."""
    out = _run(spark, sf_dir, "recently_seen", lambda s: timers.recently_seen_stream(
        s, "user_id", "ts", "event_type", "event_id", "30 days", refresh_on_read=True),
        empty_batches=False)
    return out.select(F.col("k").alias("user_id"), F.col("tb").alias("event_id"), F.col("item").alias("event_type"), "first_id", "recent_rows")


@register("stream_upserted_windows", f"""
SELECT event_type, time_bucket(INTERVAL '6 hours', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '6 hours', ts, {_EPOCH}) + INTERVAL '6 hours' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def stream_upserted_windows(spark, sf_dir):
    """O-53 on a stream: windows updated by late rows in an upsert sink, read back as their last versions; open windows included."""
    base = os.path.join(checkpoint_dir(spark), "tideline-streams", f"upserts-{uuid.uuid4().hex[:8]}")
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    ev = ev.withColumn("arrival", F.col("event_id") + F.col("event_id") * 7919 % 21 - 10)
    out = os.path.join(base, "out")
    counts = ops.window_count_with_lateness(replay(ev, base, 4, "arrival"), "event_type", "ts", "6 hours", "1 hour", "1 day")
    sinks.upsert_sink(counts, out, os.path.join(base, "ck")).awaitTermination()
    return sinks.latest_rows(spark.read.parquet(out), ["event_type", "window_start", "window_end"])


@register("stream_ingestion_windows", "SELECT user_id, count(*) AS cnt, 0 AS unstamped FROM events GROUP BY user_id")
def stream_ingestion_windows(spark, sf_dir):
    """O-43: windows over stamped arrival times; which window a row falls into is the clock's, each user's total over them isn't."""
    base = os.path.join(checkpoint_dir(spark), "tideline-streams", f"stamped-{uuid.uuid4().hex[:8]}")
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    out = os.path.join(base, "out")
    sinks.stamped_sink(replay(ev, base, 4, "event_id"), out, os.path.join(base, "ck")).awaitTermination()
    stamped = spark.read.parquet(out).withColumn("arrived", F.col("arrived").cast("timestamp_ntz"))
    per_window = windows.tumbling_count(stamped.where(F.col("arrived").isNotNull()), "user_id", "arrived", "10 seconds")
    lost = stamped.where(F.col("arrived").isNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    totals = per_window.groupBy("user_id").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    return totals.join(lost, "user_id", "left").select("user_id", "cnt", F.coalesce("n", F.lit(0)).cast("int").alias("unstamped"))
