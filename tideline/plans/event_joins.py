"""Join queries on ``events`` (clicks vs purchases per user) and on
``orders`` / ``lineitem`` (day-scale)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import joins
from tideline.plans.registry import register
from tideline.sources.tables import read_table

_EPOCH = "TIMESTAMP '1970-01-01'"


def _feeds(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = ev.where(F.col("event_type") == "click").drop("event_type")
    buys = ev.where(F.col("event_type") == "purchase").drop("event_type")
    return clicks, buys


def _ids_str(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@register("window_join_click_purchase", f"""
SELECT c.user_id, time_bucket(INTERVAL '1 day', c.ts, {_EPOCH}) AS window_start,
       time_bucket(INTERVAL '1 day', c.ts, {_EPOCH}) + INTERVAL '1 day' AS window_end,
       c.event_id AS l_event_id, p.event_id AS r_event_id
FROM events c JOIN events p
  ON c.user_id = p.user_id
 AND time_bucket(INTERVAL '1 day', c.ts, {_EPOCH}) = time_bucket(INTERVAL '1 day', p.ts, {_EPOCH})
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def window_join(spark, sf_dir):
    """O-65: clicks and purchases of a user in the same day."""
    clicks, buys = _feeds(spark, sf_dir)
    j = joins.window_join(clicks, buys, "user_id", "ts", "ts", "1 day")
    return j.select("user_id", "window_start", "window_end", "l_event_id", "r_event_id")


@register("window_cogroup_click_purchase", f"""
SELECT user_id, w AS window_start, w + INTERVAL '1 day' AS window_end,
       coalesce(array_to_string(list_sort(list(event_id) FILTER (WHERE event_type = 'click')), ','), '') AS left_values,
       coalesce(array_to_string(list_sort(list(event_id) FILTER (WHERE event_type = 'purchase')), ','), '') AS right_values
FROM (SELECT *, time_bucket(INTERVAL '1 day', ts, {_EPOCH}) AS w FROM events
      WHERE event_type IN ('click', 'purchase'))
GROUP BY user_id, w
""")
def window_cogroup(spark, sf_dir):
    """O-66: per user and day, the click ids and the purchase ids (full co-group)."""
    clicks, buys = _feeds(spark, sf_dir)
    g = joins.window_cogroup(clicks, buys, "user_id", "ts", "ts", "1 day", "event_id", "event_id", how="full")
    return g.select("user_id", "window_start", "window_end", _ids_str("left_values").alias("left_values"),
                    _ids_str("right_values").alias("right_values"))


@register("interval_join_purchase_click", """
SELECT p.user_id, p.event_id AS l_event_id, c.event_id AS r_event_id, p.ts AS l_ts, c.ts AS r_ts
FROM events p JOIN events c
  ON p.user_id = c.user_id AND c.ts BETWEEN p.ts - INTERVAL '5 hours' AND p.ts + INTERVAL '10 hours'
WHERE p.event_type = 'purchase' AND c.event_type = 'click'
""")
def interval_join(spark, sf_dir):
    """O-67: clicks from 5 h before to 10 h after each purchase (inclusive)."""
    clicks, buys = _feeds(spark, sf_dir)
    j = joins.interval_join(buys, clicks, "user_id", "ts", "ts", "-5 hours", "10 hours")
    return j.select("user_id", "l_event_id", "r_event_id", "l_ts", "r_ts")


@register("interval_join_orders_lineitem", """
SELECT o.o_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
FROM orders o JOIN lineitem l
  ON o.o_orderkey = l.l_orderkey AND l.l_shipdate BETWEEN o.o_orderdate AND o.o_orderdate + INTERVAL '30 days'
""")
def interval_join_orders(spark, sf_dir):
    """O-67 at day scale: line items shipped within 30 days of their order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = o.withColumnRenamed("o_orderkey", "okey")
    li = li.withColumnRenamed("l_orderkey", "okey")
    j = joins.interval_join(o, li, "okey", "o_orderdate", "l_shipdate", "0 days", "30 days")
    return j.select(F.col("okey").alias("o_orderkey"), F.col("r_l_linenumber").alias("l_linenumber"),
                    F.col("l_o_orderdate").alias("o_orderdate"), F.col("r_l_shipdate").alias("l_shipdate"))


@register("reconcile_click_purchase", """
SELECT coalesce(a.user_id, b.user_id) AS user_id, a.event_id AS l_id, b.event_id AS r_id, a.ts AS l_ts, b.ts AS r_ts,
       CASE WHEN a.event_id IS NULL THEN 'left_missing' WHEN b.event_id IS NULL THEN 'right_missing'
            ELSE 'matched' END AS status
FROM (SELECT * FROM events WHERE event_type = 'click') a
FULL OUTER JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
  ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL '2 hours' AND a.ts + INTERVAL '2 hours'
""")
def reconcile(spark, sf_dir):
    """O-46: app feed (clicks) vs payment feed (purchases) within 2 h."""
    clicks, buys = _feeds(spark, sf_dir)
    return joins.reconcile(clicks, buys, "user_id", "event_id", "event_id", "ts", "ts", "2 hours")


@register("orders_lineitem_join", """
SELECT o_orderkey, o_custkey, o_orderdate, l_linenumber, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def two_feed_join(spark, sf_dir):
    """O-47: unbounded inner equi-join of two feeds, left columns first."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return joins.equi_join(o, li, ["o_orderkey"], ["l_orderkey"]).drop("l_orderkey")


# Rule pairs (previous action, action) — the reference's
# (login, pay) and (login, buy) mapped onto the event types of the test data.
ACTION_RULES = [("signup", "purchase"), ("signup", "click")]


@register("consecutive_action_rules", """
SELECT user_id, event_id, ts, event_type, prev_action FROM (
  SELECT user_id, event_id, ts, event_type,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_action FROM events)
WHERE (prev_action, event_type) IN (('signup', 'purchase'), ('signup', 'click'))
""")
def consecutive_rules(spark, sf_dir):
    """O-68: a user's consecutive action pair equals a broadcast rule."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    rules = spark.createDataFrame(ACTION_RULES, "action1 string, action2 string")
    out = joins.consecutive_pair_rules(ev, "user_id", "ts", "event_type", rules, tiebreak="event_id")
    return out.select("user_id", "event_id", "ts", "event_type", "prev_action")
