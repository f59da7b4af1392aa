"""Window, top-N and windowed-aggregate queries on ``events``.

Scale mapping: the reference's seconds become hours (one user's events are
~11 h apart in the test data)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import epoch_ms
from tideline.operators import sessions, topn, windows
from tideline.operators.rows import RowsPerDistinct
from tideline.plans.registry import register
from tideline.sources.tables import read_table

_EPOCH = "TIMESTAMP '1970-01-01'"


def _events(spark, sf_dir, *cols):
    df = read_table(spark, sf_dir, "events")
    return df.select(*cols) if cols else df


# --- flagship: sliding 6 h / 3 h window counts per event type, top 2 per window (O-40 + O-69)

def sliding_top2(spark, sf_dir):
    ev = _events(spark, sf_dir, "event_type", "ts")
    counts = windows.sliding_count(ev, "event_type", "ts", "6 hours", "3 hours")
    return topn.top_n_per_group(counts, ["window_start", "window_end"], "cnt", 2, ["event_type"])


register("sliding_top2_event_types", f"""
WITH c AS (
  SELECT event_type,
         time_bucket(INTERVAL '3 hours', ts, {_EPOCH}) - INTERVAL '3 hours' * i AS window_start,
         count(*) AS cnt
  FROM (SELECT event_type, ts, unnest([0, 1]) AS i FROM events)
  GROUP BY ALL)
SELECT event_type, window_start, window_start + INTERVAL '6 hours' AS window_end, cnt, rn
FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, event_type) AS rn FROM c)
WHERE rn <= 2
""")(sliding_top2)


@register("sliding_count_event_types", f"""
SELECT event_type, window_start, window_start + INTERVAL '6 hours' AS window_end, count(*) AS cnt
FROM (SELECT event_type,
             time_bucket(INTERVAL '3 hours', ts, {_EPOCH}) - INTERVAL '3 hours' * unnest([0, 1]) AS window_start
      FROM events)
GROUP BY ALL
""")
def sliding_counts(spark, sf_dir):
    """O-40 alone."""
    return windows.sliding_count(_events(spark, sf_dir, "event_type", "ts"), "event_type", "ts",
                                 "6 hours", "3 hours")


@register("tumbling_count_per_user", f"""
SELECT user_id, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 day', ts, {_EPOCH}) + INTERVAL '1 day' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def tumbling_per_user(spark, sf_dir):
    """O-38: events per user per day."""
    return windows.tumbling_count(_events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", "1 day")


@register("tumbling_offset_count", f"""
SELECT event_type, time_bucket(INTERVAL '1 day', ts, {_EPOCH} + INTERVAL '6 hours') AS window_start,
       time_bucket(INTERVAL '1 day', ts, {_EPOCH} + INTERVAL '6 hours') + INTERVAL '1 day' AS window_end,
       count(*) AS cnt
FROM events GROUP BY ALL
""")
def tumbling_offset(spark, sf_dir):
    """O-39: daily windows starting at 06:00."""
    return windows.tumbling_count(_events(spark, sf_dir, "event_type", "ts"), "event_type", "ts",
                                  "1 day", offset="6 hours")


@register("window_all_daily", f"""
SELECT time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 day', ts, {_EPOCH}) + INTERVAL '1 day' AS window_end,
       count(*) AS cnt, round(sum(value), 6) AS total_value
FROM events GROUP BY ALL
""")
def window_all(spark, sf_dir):
    """O-50: non-keyed window (partial aggregation, not one task)."""
    out = windows.window_agg(_events(spark, sf_dir, "ts", "value"), None, "ts", "1 day",
                             aggs=[F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("total_value")])
    return out.withColumn("total_value", F.round("total_value", 6))


@register("sliding_pv_per_uv", f"""
SELECT window_start, window_start + INTERVAL '10 hours' AS window_end,
       count(*) AS pv, count(DISTINCT user_id) AS uv, round(count(*) / count(DISTINCT user_id), 6) AS pv_per_uv
FROM (SELECT user_id,
             time_bucket(INTERVAL '2 hours', ts, {_EPOCH}) - INTERVAL '2 hours' * unnest([0, 1, 2, 3, 4]) AS window_start
      FROM events)
GROUP BY ALL
""")
def sliding_pv_uv(spark, sf_dir):
    """O-41: sliding 10 h / 2 h, pv / uv over all users."""
    return windows.pv_per_uv(_events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", "10 hours", "2 hours")


@register("tumbling_uv", f"""
SELECT time_bucket(INTERVAL '10 hours', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '10 hours', ts, {_EPOCH}) + INTERVAL '10 hours' AS window_end,
       count(DISTINCT user_id) AS uv
FROM events GROUP BY ALL
""")
def tumbling_uv(spark, sf_dir):
    """O-42: distinct users per 10 h."""
    return windows.distinct_count_window(_events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", "10 hours")


@register("manual_tumbling_per_user", f"""
SELECT user_id, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 day', ts, {_EPOCH}) + INTERVAL '1 day' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def manual_tumbling(spark, sf_dir):
    """O-59: hand-assigned buckets; same rows as tumbling_count_per_user."""
    return windows.manual_tumbling_count(_events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", "1 day")


_SESSION_SQL = """
WITH o AS (
  SELECT user_id, ts, {gap} AS gap,
         max(ts + {gap}) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
  FROM events),
s AS (
  SELECT *, sum(CASE WHEN prev_end IS NULL OR ts > prev_end THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
  FROM o)
SELECT user_id, min(ts) AS session_start, max(ts + gap) AS session_end, count(*) AS cnt
FROM s GROUP BY user_id, sid
"""


@register("session_per_user", _SESSION_SQL.format(gap="INTERVAL '12 hours'"))
def session_fixed(spark, sf_dir):
    """O-44: sessions per user with a 12 h gap."""
    return windows.session_windows(_events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", "12 hours")


@register("session_dynamic_gap", _SESSION_SQL.format(gap="(INTERVAL '2 hours' * length(event_type))"))
def session_dynamic(spark, sf_dir):
    """O-45: gap depends on the row: 2 h per character of its event type."""
    ev = _events(spark, sf_dir, "user_id", "ts", "event_type")
    gap = F.concat((F.length("event_type") * 2).cast("string"), F.lit(" hours"))
    return windows.session_windows(ev, "user_id", "ts", gap)


@register("session_varying_gap_split", _SESSION_SQL.format(gap="(INTERVAL '2 hours' * (1 + event_id % 20))"))
def session_varying_split(spark, sf_dir):
    """O-45 with gaps of 2 to 40 h from row to row, every user split into buckets of about 16 rows."""
    ev = _events(spark, sf_dir, "user_id", "ts", "event_id")
    gap = F.concat(((F.col("event_id") % 20 + 1) * 2).cast("string"), F.lit(" hours"))
    return windows.session_windows(ev, "user_id", "ts", gap, slot="1 hour", target_rows=16)


@register("cumulative_window_event_types", f"""
WITH p AS (
  SELECT event_type, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w,
         CAST(floor(epoch_us(ts - time_bucket(INTERVAL '1 day', ts, {_EPOCH})) / 21600000000) AS INTEGER) AS i
  FROM events)
SELECT event_type, w AS window_start, w + INTERVAL '6 hours' * (j + 1) AS window_end, count(*) AS cnt
FROM (SELECT event_type, w, unnest(range(i, 4)) AS j FROM p)
GROUP BY ALL
""")
def cumulative(spark, sf_dir):
    """O-55: cumulate(step 6 h, max 1 day) per event type."""
    return windows.cumulative_window(_events(spark, sf_dir, "event_type", "ts"), "event_type", "ts",
                                     "6 hours", "1 day")


@register("early_fire_counts", f"""
WITH p AS (
  SELECT event_type, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w,
         CAST(ceil(epoch_us(ts - time_bucket(INTERVAL '1 day', ts, {_EPOCH})) / 21600000000) AS INTEGER) AS i
  FROM events)
SELECT event_type, w AS window_start, w + INTERVAL '1 day' AS window_end,
       w + INTERVAL '6 hours' * j AS fire_time, count(*) AS cnt
FROM (SELECT event_type, w, unnest(range(i, 5)) AS j FROM p)
GROUP BY ALL
""")
def early_fire(spark, sf_dir):
    """O-51: daily window per event type that also fires every 6 h."""
    return windows.early_fire(_events(spark, sf_dir, "event_type", "ts"), "event_type", "ts", "1 day", "6 hours")


@register("keep_last_per_window", f"""
SELECT event_type, w AS window_start, w + INTERVAL '1 day' AS window_end, count(*) AS cnt,
       round(sum(value), 6) AS total
FROM (SELECT event_type, value, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w,
             row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL '1 day', ts, {_EPOCH})
                                ORDER BY ts DESC) AS rn
      FROM events)
WHERE rn <= 10 GROUP BY ALL
""")
def keep_last(spark, sf_dir):
    """O-52 evictor: only the last 10 rows of each daily window count."""
    out = windows.keep_last(_events(spark, sf_dir, "event_type", "ts", "value"), "event_type", "ts",
                            "1 day", 10, "value")
    return out.withColumn("total", F.round("total", 6))


@register("sql_tumble_per_user", f"""
SELECT user_id, time_bucket(INTERVAL '1 hour', ts, {_EPOCH}) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM events GROUP BY ALL
""")
def sql_tumble(spark, sf_dir):
    """O-56: the SQL TVF form, written as Spark SQL over a temp view."""
    _events(spark, sf_dir, "user_id", "ts").createOrReplaceTempView("tl_events")
    return spark.sql("""
        SELECT user_id, window.end AS window_end, count(*) AS cnt
        FROM tl_events GROUP BY user_id, window(ts, '1 hour')""")


@register("sql_window_top2_users", f"""
WITH c AS (
  SELECT user_id, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS window_start, count(*) AS cnt
  FROM events GROUP BY ALL)
SELECT user_id, window_start, window_start + INTERVAL '1 day' AS window_end, cnt, rn
FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS rn FROM c)
WHERE rn <= 2
""")
def sql_window_topn(spark, sf_dir):
    """O-69 in SQL text: daily top-2 users by event count."""
    _events(spark, sf_dir, "user_id", "ts").createOrReplaceTempView("tl_events_u")
    return spark.sql("""
        SELECT user_id, window_start, window_end, cnt, rn FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end
                                            ORDER BY cnt DESC, user_id) AS BIGINT) AS rn
          FROM (SELECT user_id, window.start AS window_start, window.end AS window_end, count(*) AS cnt
                FROM tl_events_u GROUP BY user_id, window(ts, '1 day')))
        WHERE rn <= 2""")


@register("two_stage_top2_event_types", f"""
WITH c AS (
  SELECT event_type,
         time_bucket(INTERVAL '3 hours', ts, {_EPOCH}) - INTERVAL '3 hours' * i + INTERVAL '6 hours' AS window_end,
         count(*) AS cnt
  FROM (SELECT event_type, ts, unnest([0, 1]) AS i FROM events)
  GROUP BY ALL)
SELECT event_type, window_end, cnt, rn
FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, event_type) AS rn FROM c)
WHERE rn <= 2
""")
def two_stage_topn(spark, sf_dir):
    """O-70: count per (event type, window), regroup by window end, keep 2 —
    the append-mode-compatible aggregate form (same answer as O-69)."""
    counts = windows.sliding_count(_events(spark, sf_dir, "event_type", "ts"), "event_type", "ts",
                                   "6 hours", "3 hours")
    return topn.top_n_by_aggregate(counts, ["window_end"], "event_type", "cnt", 2)


@register("sliding_top2_users", f"""
WITH c AS (
  SELECT user_id,
         time_bucket(INTERVAL '12 hours', ts, {_EPOCH}) - INTERVAL '12 hours' * i AS window_start,
         count(*) AS cnt
  FROM (SELECT user_id, ts, unnest([0, 1]) AS i FROM events)
  GROUP BY ALL)
SELECT user_id, window_start, window_start + INTERVAL '1 day' AS window_end, cnt, rn
FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS rn FROM c)
WHERE rn <= 2
""")
def all_window_topn(spark, sf_dir):
    """O-71: one-stage top-2 over all rows of a sliding 1 day / 12 h window,
    counting users (as the reference program does)."""
    counts = windows.sliding_count(_events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", "1 day", "12 hours")
    return topn.top_n_per_group(counts, ["window_start", "window_end"], "cnt", 2, ["user_id"])


@register("users_by_count_desc", """
SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id
""")
def sorted_counts(spark, sf_dir):
    """O-72: users ordered by event count desc (range-partitioned global sort)."""
    c = _events(spark, sf_dir, "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return topn.sort_by_count(c, "cnt", ["user_id"])


@register("ms_to_event_time", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS event_ts FROM events
""")
def ms_event_time(spark, sf_dir):
    """O-64: epoch milliseconds -> event-time column and back."""
    from tideline.functions.time import ntz_from_ms
    ev = _events(spark, sf_dir, "event_id", "ts").select("event_id", epoch_ms("ts").alias("ms"))
    return ev.withColumn("event_ts", ntz_from_ms("ms"))


@register("session_user_aggregate", """
WITH o AS (SELECT user_id, ts, event_type, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev, event_id FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL '12 hours' THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '12 hours' AS session_end,
       round(count(*) / count(DISTINCT event_type), 6) AS rows_per_type
FROM s GROUP BY user_id, sid
""")
def session_user_aggregate(spark, sf_dir):
    """O-44 with a user-defined aggregate (rows per distinct type); a user's rows are split into buckets of
    about five, so most sessions are merged from several."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    out = sessions.session_aggregate(ev, "user_id", "ts", "12 hours", ["event_type"], RowsPerDistinct("event_type"), "double",
                                     "rows_per_type", slot="1 hour", target_rows=5)
    return out.withColumn("rows_per_type", F.round("rows_per_type", 6))


@register("session_user_aggregate_varying_gap", """
WITH e AS (SELECT user_id, ts, event_id, event_type, ts + length(event_type) * INTERVAL '3 hours' AS until FROM events),
o AS (SELECT *, max(until) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
s AS (SELECT *, sum(CASE WHEN reach IS NULL OR ts > reach THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, min(ts) AS session_start, max(until) AS session_end,
       round(count(*) / count(DISTINCT event_type), 6) AS rows_per_type FROM s GROUP BY user_id, sid
""")
def session_user_aggregate_varying_gap(spark, sf_dir):
    """O-45 with a user-defined aggregate: the gap is three hours per letter of the type."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    gap = F.length("event_type").cast("long") * F.lit(3 * 3_600_000_000)
    out = sessions.session_aggregate(ev, "user_id", "ts", gap, ["event_type"], RowsPerDistinct("event_type"), "double",
                                     "rows_per_type", slot="1 hour", target_rows=5)
    return out.withColumn("rows_per_type", F.round("rows_per_type", 6))


_UV_EXACT = """
SELECT w AS window_start, w + INTERVAL '2 days' AS window_end, count(*) AS pv, count(DISTINCT user_id) AS uv, true AS close
FROM (SELECT time_bucket(INTERVAL '8 hours', ts, TIMESTAMP '1970-01-01') - i * INTERVAL '8 hours' AS w, user_id
      FROM events, (SELECT unnest(range(6)) AS i))
"""


@register("sliding_uv_sketch", _UV_EXACT + "GROUP BY w")
def sliding_uv_sketch(spark, sf_dir):
    """O-41 by sketches per pane, held against the exact count: ``close`` within four standard errors."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts")
    est = windows.distinct_by_sketch(ev, "user_id", "ts", "2 days", "8 hours")
    exact = windows.pv_per_uv(ev, "user_id", "ts", "2 days", "8 hours").select("window_start", "uv")
    close = F.abs(F.col("uv_estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * (4 * windows.SKETCH_ERROR))
    return est.join(exact, "window_start").select("window_start", "window_end", "pv", "uv", close.alias("close"))
