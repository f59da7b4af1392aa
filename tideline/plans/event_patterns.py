"""Pattern, sequential-state, late-data and sink-batching queries on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import ntz_from_us
from tideline.operators import eventtime, patterns, scan
from tideline.plans.registry import register
from tideline.sources.tables import read_table


def _events(spark, sf_dir, *cols):
    df = read_table(spark, sf_dir, "events")
    return df.select(*cols) if cols else df


@register("three_errors_in_a_row", """
SELECT * FROM (
  SELECT user_id, event_id AS event_id_1, lead(event_id, 1) OVER w AS event_id_2, lead(event_id, 2) OVER w AS event_id_3,
         ts AS ts_1, lead(ts, 1) OVER w AS ts_2, lead(ts, 2) OVER w AS ts_3,
         event_type = 'error' AND lead(event_type, 1) OVER w = 'error' AND lead(event_type, 2) OVER w = 'error' AS hit
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE hit
""")
def three_errors(spark, sf_dir):
    """O-78: three consecutive 'error' events of a user (strict contiguity)."""
    ev = _events(spark, sf_dir, "user_id", "event_id", "ts", "event_type")
    e = F.col("event_type") == "error"
    out = patterns.strict_sequence(ev, "user_id", "ts", [e, e, e], ["event_id", "ts"], tiebreak="event_id")
    return out.withColumn("hit", F.lit(True))


@register("signup_then_purchase_within_day", """
SELECT s.user_id, s.event_id AS start_id, s.ts AS start_ts,
       CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN p.event_id END AS end_id,
       CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN p.ts END AS end_ts,
       CASE WHEN p.ts < s.ts + INTERVAL '1 day' THEN 'matched' ELSE 'timeout' END AS status
FROM events s
LEFT JOIN LATERAL (SELECT event_id, ts FROM events e
                   WHERE e.user_id = s.user_id AND e.event_type = 'purchase' AND (e.ts, e.event_id) > (s.ts, s.event_id)
                   ORDER BY e.ts, e.event_id LIMIT 1) p ON true
WHERE s.event_type = 'signup'
""")
def followed_by(spark, sf_dir):
    """O-79: signup followed by a purchase within 1 day -> matched; else timeout."""
    ev = _events(spark, sf_dir, "user_id", "event_id", "ts", "event_type")
    return patterns.followed_by_within(ev, "user_id", "ts", F.col("event_type") == "signup",
                                       F.col("event_type") == "purchase", "1 day", "event_id")


# Login-failure state machine — (state, event, next state).
# 'error' plays the failed login, 'purchase' the successful one.
LOGIN_FAIL_TRANSITIONS = [
    ("Initial", "error", "S1"), ("Initial", "purchase", "Terminal"),
    ("S1", "error", "S2"), ("S1", "purchase", "Terminal"),
    ("S2", "error", "Matched"), ("S2", "purchase", "Terminal"),
]


@register("state_machine_alerts", """
SELECT user_id, event_id, ts FROM (
  SELECT user_id, event_id, ts, event_type = 'error' AND lag(event_type, 1) OVER w = 'error'
                                AND lag(event_type, 2) OVER w = 'error' AS hit
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE hit
""")
def state_machine(spark, sf_dir):
    """O-80: explicit transition table run per user; alerts on 'Matched'."""
    ev = _events(spark, sf_dir, "user_id", "event_id", "ts", "event_type")
    return scan.run_state_machine(ev, "user_id", "ts", "event_type", LOGIN_FAIL_TRANSITIONS, "Initial", "Matched",
                                  "Terminal", ["event_id", "ts"], tiebreak="event_id")


@register("periodic_pv_per_user", """
WITH RECURSIVE chain(user_id, fire) AS (
  SELECT user_id, min(ts) + INTERVAL '10 hours' FROM events GROUP BY user_id
  UNION ALL
  SELECT c.user_id, n.nt + INTERVAL '10 hours'
  FROM chain c, LATERAL (SELECT min(ts) AS nt FROM events e WHERE e.user_id = c.user_id AND e.ts > c.fire) n
  WHERE n.nt IS NOT NULL)
SELECT user_id, fire AS fire_time,
       (SELECT count(*) FROM events e WHERE e.user_id = chain.user_id AND e.ts <= chain.fire) AS cnt
FROM chain
""")
def periodic_pv(spark, sf_dir):
    """O-76: cumulative events per user reported 10 h after the first event
    since the last report; a user's rows are split into buckets of about 20."""
    ev = _events(spark, sf_dir, "user_id", "ts", "event_id")
    out = scan.periodic_count(ev, "user_id", "ts", "10 hours", target_rows=20)
    return out.select("user_id", ntz_from_us("fire_us").alias("fire_time"), "cnt")


def _arrival(df):
    # arrival order: event ids displaced by up to 49 places (a deterministic shuffle)
    return df.withColumn("arrival", F.col("event_id") + F.pmod(F.col("event_id") * 37, F.lit(50)))


_LATE_SQL = """
SELECT event_id, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
       coalesce(time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour'
                <= max(ts) OVER (ORDER BY event_id + (event_id * 37) % 50, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '{delay}', false) AS is_late
FROM events
"""


@register("late_events_split", _LATE_SQL.format(delay="5 minutes"))
def late_split(spark, sf_dir):
    """O-54: rows arriving after their hourly window closed (5 min delay)."""
    ev = _arrival(_events(spark, sf_dir, "event_id", "ts"))
    out = eventtime.split_late(ev, "ts", "arrival", "1 hour", "5 minutes", block_width=2_000, tiebreak="event_id")
    return out.select("event_id", "window_start", "window_end", "is_late")


@register("on_time_counts_with_lateness", "SELECT event_type, window_start, window_end, count(*) AS cnt FROM (" +
          _LATE_SQL.replace("SELECT event_id,", "SELECT event_type,").format(delay="35 minutes") +
          ") WHERE NOT is_late GROUP BY ALL")
def on_time_counts(spark, sf_dir):
    """O-53: hourly counts per type, 5 min disorder + 30 min allowed lateness."""
    ev = _arrival(_events(spark, sf_dir, "event_id", "ts", "event_type"))
    return eventtime.on_time_window_counts(ev, "event_type", "ts", "arrival", "1 hour", "5 minutes",
                                           lateness="30 minutes", block_width=2_000)


@register("buffered_batches", """
SELECT event_id, idx // 10 AS batch_no FROM (
  SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx, count(*) OVER () AS n FROM events)
WHERE idx < (n // 10) * 10
""")
def buffered_batches(spark, sf_dir):
    """O-08: rows emitted in groups of 10 in arrival order; the last partial
    group is held back."""
    from tideline.sources.sinks import assign_batches
    return assign_batches(_events(spark, sf_dir, "event_id"), "event_id", 10, block_width=2_000)
