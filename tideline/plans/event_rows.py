"""Row, routing, layout and keyed-aggregate queries on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import epoch_ms
from tideline.operators import aggs, layout, route, rows, table_functions
from tideline.operators.sequence import running_aggregates
from tideline.plans.registry import register
from tideline.sources import codec
from tideline.sources.tables import read_table


def _events(spark, sf_dir, *cols):
    df = read_table(spark, sf_dir, "events")
    return df.select(*cols) if cols else df


@register("sql_projection", "SELECT event_type, user_id FROM events")
def sql_projection(spark, sf_dir):
    """O-10 / O-16: ``select urls, users from t`` as Spark SQL."""
    _events(spark, sf_dir).createOrReplaceTempView("tl_events_p")
    return spark.sql("SELECT event_type, user_id FROM tl_events_p")


@register("key_one_pairs", "SELECT user_id, CAST(1 AS BIGINT) AS one FROM events")
def key_one(spark, sf_dir):
    """O-11: (key, 1L)."""
    return rows.key_one(_events(spark, sf_dir, "user_id"), "user_id")


@register("sql_filter_purchases", "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'")
def sql_filter(spark, sf_dir):
    """O-12 / O-17 equality filter; pushed into the parquet scan."""
    _events(spark, sf_dir).createOrReplaceTempView("tl_events_f")
    return spark.sql("SELECT event_id, user_id, ts FROM tl_events_f WHERE event_type = 'purchase'")


@register("filter_props_contains", """SELECT event_id, props FROM events WHERE contains(props, '"k": 7')""")
def filter_contains(spark, sf_dir):
    """O-12 substring filter."""
    return rows.filter_contains(_events(spark, sf_dir, "event_id", "props"), "props", '"k": 7')


@register("flat_map_by_type", """
SELECT unnest(CASE WHEN event_type = 'purchase' THEN [CAST(user_id AS VARCHAR)]
                   ELSE [CAST(user_id AS VARCHAR), event_type] END) AS value
FROM events
""")
def flat_map(spark, sf_dir):
    """O-13: purchases -> [user]; other rows -> [user, event type]."""
    return rows.flat_map_by_rule(_events(spark, sf_dir, "user_id", "event_type"),
                                 F.col("event_type") == "purchase", ["user_id"], ["user_id", "event_type"])


@register("emit_n_per_row", """
SELECT unnest(CASE WHEN event_type = 'purchase' THEN [user_id]
                   WHEN event_type = 'click' THEN [user_id, user_id] ELSE [] END) AS value
FROM events
""")
def emit_n(spark, sf_dir):
    """O-14: purchase once, click twice, others never."""
    ev = _events(spark, sf_dir, "user_id", "event_type")
    n = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).otherwise(0)
    return rows.emit_n(ev, "user_id", n)


def _rich_open():
    return {"divisor": 1000}


def _rich_map(res, b):
    import pandas as pd
    us = (b["ts"] - pd.Timestamp("1970-01-01")) // pd.Timedelta(microseconds=1)
    return pd.DataFrame({"event_id": b["event_id"], "ms": (us // res["divisor"]).astype("int64")})


def _rich_close(res):
    res.clear()


@register("rich_map_ms", "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def rich_map(spark, sf_dir):
    """O-15: per-task open/map/close around an Arrow-batched map."""
    return rows.rich_map(_events(spark, sf_dir, "event_id", "ts"), _rich_open, _rich_map, _rich_close,
                         "event_id long, ms long")


@register("encode_event_lines", """
SELECT printf('Event{users=''%s'', urls=''%s'', timestamp=%s}', CAST(user_id AS VARCHAR), event_type,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%g')) AS line
FROM events
""")
def encode_lines(spark, sf_dir):
    """O-09: row -> display string."""
    return codec.encode_event(_events(spark, sf_dir, "user_id", "event_type", "ts"), "user_id", "event_type", "ts")


@register("parse_delimited_lines", """
SELECT CAST(user_id AS VARCHAR) AS users, event_type AS urls, epoch_us(ts) // 1000 AS ms, 'main' AS route
FROM events
""")
def parse_lines(spark, sf_dir):
    """O-02 / O-03: lines 'user, type, ms' (written from the table) parsed
    back with split + trim + try_cast; malformed lines would get route 'bad'."""
    ev = _events(spark, sf_dir, "user_id", "event_type", "ts")
    lines = ev.select(F.concat_ws(", ", F.col("user_id").cast("string"), "event_type",
                                  epoch_ms("ts").cast("string")).alias("line"))
    return codec.parse_delimited(lines, "line", [("users", "string"), ("urls", "string"), ("ms", "bigint")])


@register("kafka_payload", """
SELECT CAST(user_id AS VARCHAR) AS key,
       concat_ws(',', CAST(user_id AS VARCHAR), event_type, CAST(epoch_us(ts) // 1000 AS VARCHAR)) AS value
FROM events
""")
def kafka_payload(spark, sf_dir):
    """O-06: one string record per row, the form a Kafka sink takes."""
    ev = _events(spark, sf_dir, "user_id", "event_type", "ts")
    return codec.kafka_records(ev, F.col("user_id").cast("string"),
                               [F.col("user_id").cast("string"), F.col("event_type"), epoch_ms("ts").cast("string")])


@register("keyed_sum_min_max", """
SELECT user_id, round(sum(value), 6) AS sum_value, min(value) AS min_value, max(value) AS max_value
FROM events GROUP BY user_id
""")
def keyed_sum_min_max(spark, sf_dir):
    """O-32."""
    out = aggs.keyed_sum_min_max(_events(spark, sf_dir, "user_id", "value"), "user_id", "value")
    return out.withColumn("sum_value", F.round("sum_value", 6))


@register("keyed_min_max_by", """
SELECT user_id,
       arg_min(event_id, (value, event_id)) AS min_event_id, min(value) AS min_value,
       arg_min(event_id, (-value, event_id)) AS max_event_id, max(value) AS max_value
FROM events GROUP BY user_id
""")
def keyed_min_max_by(spark, sf_dir):
    """O-33: row of the min / max value per user (ties: first event)."""
    return aggs.keyed_min_max_by(_events(spark, sf_dir, "user_id", "value", "event_id"), "user_id", "value",
                                 "event_id", ["event_id", "value"])


@register("running_min_by", """
SELECT user_id, event_id AS at, m.e AS min_event_id, m.v AS min_value
FROM (SELECT user_id, event_id,
             min({'v': value, 'e': event_id}) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                    ROWS UNBOUNDED PRECEDING) AS m
      FROM events)
""")
def running_min_by(spark, sf_dir):
    """O-34: after each event, the user's event with the smallest value so far."""
    out = aggs.running_min_by(_events(spark, sf_dir, "user_id", "ts", "value", "event_id"), "user_id", "ts",
                              "value", "event_id", ["event_id", "value"])
    return out.withColumnRenamed("min_event_id", "min_event_id")


@register("running_count_sum", """
SELECT user_id, event_id,
       count(*) OVER w AS running_count, round(sum(value) OVER w, 6) AS running_sum
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def running_count_sum(spark, sf_dir):
    """O-35: reduce-style running count and sum per user."""
    out = running_aggregates(_events(spark, sf_dir, "user_id", "ts", "value", "event_id"), "user_id", "ts",
                             "value", tiebreak="event_id")
    return out.select("user_id", "event_id", "running_count", F.round("running_sum", 6).alias("running_sum"))


@register("sql_group_count", "SELECT user_id, count(event_type) AS cnt FROM events GROUP BY user_id")
def sql_group_count(spark, sf_dir):
    """O-36: ``select users, count(urls) ... group by users``."""
    _events(spark, sf_dir).createOrReplaceTempView("tl_events_g")
    return spark.sql("SELECT user_id, count(event_type) AS cnt FROM tl_events_g GROUP BY user_id")


@register("global_window_per_type", """
SELECT event_type, count(event_id) AS cnt FROM events GROUP BY event_type
""")
def global_window(spark, sf_dir):
    """O-49: global window = unwindowed keyed aggregate (stream: update mode)."""
    return aggs.group_count(_events(spark, sf_dir, "event_type", "event_id"), "event_type", "event_id")


@register("first5_average_ts", """
SELECT user_id, CAST(floor(sum(ms) / 5) AS BIGINT) AS avg_ms,
       make_timestamp(CAST(floor(sum(ms) / 5) AS BIGINT) * 1000) AS avg_ts
FROM (SELECT user_id, epoch_us(ts) // 1000 AS ms,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= 5 GROUP BY user_id HAVING count(*) = 5
""")
def first5_avg(spark, sf_dir):
    """O-37: integer mean of the first 5 epoch-ms timestamps per user."""
    return aggs.first_n_average_ms(_events(spark, sf_dir, "user_id", "ts", "event_id"), "user_id", "ts", 5,
                                   tiebreak="event_id")


@register("count_window_tumbling", """
SELECT user_id, (rn - 1) // 10 AS block, count(*) AS cnt, round(sum(value), 6) AS total
FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
GROUP BY ALL HAVING count(*) = 10
""")
def count_window_tumbling(spark, sf_dir):
    """O-48 countWindow(10)."""
    out = aggs.count_window_tumbling(_events(spark, sf_dir, "user_id", "ts", "value", "event_id"), "user_id",
                                     "ts", 10, "value", tiebreak="event_id")
    return out.withColumn("total", F.round("total", 6))


@register("count_window_sliding", """
SELECT user_id, rn AS fire_seq, cnt, total
FROM (SELECT user_id, row_number() OVER w0 AS rn, count(*) OVER w AS cnt, round(sum(value) OVER w, 6) AS total
      FROM events
      WINDOW w0 AS (PARTITION BY user_id ORDER BY ts, event_id),
             w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
WHERE rn % 3 = 0
""")
def count_window_sliding(spark, sf_dir):
    """O-48 countWindow(10, 3)."""
    out = aggs.count_window_sliding(_events(spark, sf_dir, "user_id", "ts", "value", "event_id"), "user_id",
                                    "ts", 10, 3, "value", tiebreak="event_id")
    return out.withColumn("total", F.round("total", 6))


@register("changelog_count_per_user", """
WITH s AS (SELECT user_id, ts, event_id,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events)
SELECT user_id, ts, event_id, '+I' AS op, seq AS cnt, 1 AS op_order FROM s WHERE seq = 1
UNION ALL SELECT user_id, ts, event_id, '-U', seq - 1, 0 FROM s WHERE seq > 1
UNION ALL SELECT user_id, ts, event_id, '+U', seq, 1 FROM s WHERE seq > 1
""")
def changelog(spark, sf_dir):
    """O-57: +I / -U / +U changelog of a running count per user."""
    return aggs.changelog_count(_events(spark, sf_dir, "user_id", "ts", "event_id"), "user_id", "ts",
                                tiebreak="event_id")


@register("udaf_mean_value", "SELECT event_type, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type")
def udaf_mean(spark, sf_dir):
    """O-19: user-defined aggregate (create / add / merge / result), accumulated per task."""
    ev = _events(spark, sf_dir, "event_type", "value")
    out = rows.user_aggregate(ev, "event_type", ["value"], rows.MeanOf("value"), "double")
    return out.select("event_type", F.round("value", 6).alias("mean_value"))


@register("udaf_pv_per_user", """
SELECT event_type, round(count(*) / count(DISTINCT user_id), 6) AS pv_per_user FROM events GROUP BY event_type
""")
def udaf_pv_per_user(spark, sf_dir):
    """O-19: views per distinct user with a set as accumulator."""
    ev = _events(spark, sf_dir, "event_type", "user_id")
    out = rows.user_aggregate(ev, "event_type", ["user_id"], rows.RowsPerDistinct("user_id"), "double")
    return out.select("event_type", F.round("value", 6).alias("pv_per_user"))


@register("running_sum_with_nulls", """
WITH e AS (SELECT CASE WHEN user_id % 3 > 0 THEN user_id % 3 END AS grp, ts, event_id,
                  CASE WHEN event_id % 4 > 0 THEN event_id % 100 END AS v FROM events)
SELECT grp, event_id, count(*) OVER w AS running_count, CAST(sum(v) OVER w AS BIGINT) AS running_sum,
       min(v) OVER w AS running_min, max(v) OVER w AS running_max
FROM e WINDOW w AS (PARTITION BY grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def running_sum_with_nulls(spark, sf_dir):
    """O-35 with null keys and values; three large keys, each split into buckets of rows."""
    ev = _events(spark, sf_dir, "user_id", "ts", "event_id")
    ev = ev.select(F.when(F.col("user_id") % 3 > 0, F.col("user_id") % 3).alias("grp"), "ts", "event_id",
                   F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 100).alias("v"))
    out = running_aggregates(ev, "grp", "ts", "v", tiebreak="event_id", target_rows=500)
    return out.select("grp", "event_id", "running_count", "running_sum", "running_min", "running_max")


@register("split_routes", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'paid' WHEN event_type = 'error' THEN 'alert'
                      ELSE 'main' END AS route
FROM events
""")
def split_routes(spark, sf_dir):
    """O-27 / O-28: first matching rule picks the output."""
    ev = _events(spark, sf_dir, "event_id", "event_type")
    out = route.add_route(ev, [("paid", F.col("event_type") == "purchase"), ("alert", F.col("event_type") == "error")])
    return out.select("event_id", "route")


@register("union_same_type", """
SELECT event_id, user_id FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, user_id FROM events WHERE event_type = 'view'
""")
def union_same(spark, sf_dir):
    """O-29: union of two same-typed inputs."""
    ev = _events(spark, sf_dir, "event_id", "user_id", "event_type")
    a = ev.where(F.col("event_type") == "click").select("event_id", "user_id")
    b = ev.where(F.col("event_type") == "view").select("event_id", "user_id")
    return route.union_all(a, b)


@register("connect_comap", """
SELECT 'Integer: ' || CAST(CAST(user_id AS INTEGER) AS VARCHAR) AS value FROM events WHERE event_type = 'view'
UNION ALL SELECT 'Long: ' || CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'purchase'
""")
def connect_comap(spark, sf_dir):
    """O-30: two inputs of different types mapped to one string stream."""
    ev = _events(spark, sf_dir, "event_id", "user_id", "event_type")
    ints = ev.where(F.col("event_type") == "view").select(F.col("user_id").cast("int").alias("i"))
    longs = ev.where(F.col("event_type") == "purchase").select(F.col("event_id").alias("l"))
    both = route.connect(ints, longs)
    return both.select(F.when(F.col("side") == "left", F.concat(F.lit("Integer: "), F.col("i").cast("string")))
                        .otherwise(F.concat(F.lit("Long: "), F.col("l").cast("string"))).alias("value"))


@register("custom_partition_parity", "SELECT event_id, user_id, user_id % 2 AS pid FROM events")
def custom_partition(spark, sf_dir):
    """O-26: rows placed by ``user_id mod 2``; pid is the partition they land in."""
    ev = _events(spark, sf_dir, "event_id", "user_id")
    return layout.with_partition_id(layout.partition_custom(ev, 2, F.col("user_id")))


@register("broadcast_copies", "SELECT event_id, unnest(range(4)) AS copy FROM events")
def broadcast_copies(spark, sf_dir):
    """O-24: every row to each of 4 downstream tasks."""
    return layout.broadcast_copies(_events(spark, sf_dir, "event_id"), 4)


@register("repartition_roundtrip", "SELECT event_type, count(*) AS cnt, round(sum(value), 6) AS total FROM events GROUP BY 1")
def repartition_roundtrip(spark, sf_dir):
    """O-20…O-25: key_by / shuffle / rebalance / rescale / global leave rows
    unchanged; the keyed aggregate after key_by reuses its partitioning."""
    ev = _events(spark, sf_dir, "event_type", "value")
    ev = layout.rescale(layout.rebalance(layout.shuffle(ev, 8), 6), 3)
    keyed = layout.key_by(ev, "event_type")
    out = keyed.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"), F.round(F.sum("value"), 6).alias("total"))
    return layout.to_single(out)


@register("decode_json_payload", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def decode_payload(spark, sf_dir):
    """O-05: message value (JSON text) -> typed columns, as after a Kafka source."""
    ev = _events(spark, sf_dir, "event_id", "props")
    return codec.decode_kafka_value(ev, "k bigint", value="props", keep=["event_id"])


@register("flat_map_function", """
SELECT event_id, lower(part) AS word, length(part) AS size
FROM (SELECT event_id, unnest(regexp_extract_all(event_type || ' ' || props, '[A-Za-z]+|[0-9]+')) AS part FROM events)
""")
def flat_map_function(spark, sf_dir):
    """O-13 / O-18: a user's flatMap as a table function: the words and numbers of two columns."""
    def words(event_type, props):
        import re
        for w in re.findall("[A-Za-z]+|[0-9]+", f"{event_type} {props}"):
            yield w.lower(), len(w)
    return table_functions.flat_map_function(_events(spark, sf_dir, "event_id", "event_type", "props"), words, ["event_type", "props"],
                                             "word string, size bigint", ["event_id"])


@register("keyed_table_function", """
WITH r AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
                  - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS run FROM events)
SELECT user_id, event_type, min(event_id) AS first_id, count(*) AS length FROM r GROUP BY user_id, event_type, run
""")
def keyed_table_function(spark, sf_dir):
    """O-18: a table function over each user's rows in order: runs of equal event types."""
    def step(run, row):
        if run and run[0] == row["event_type"]:
            run[2] += 1
        else:
            if run:
                yield tuple(run)
            run[:] = [row["event_type"], row["event_id"], 1]

    return table_functions.keyed_table_function(
        _events(spark, sf_dir, "user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], ["event_type"],
        list, step, lambda run: [tuple(run)], "event_type string, first_id bigint, length bigint")


@register("reduce_function", "SELECT event_type, count(*) AS n, max(event_id) AS event_id, min(user_id) AS user_id FROM events GROUP BY event_type")
def reduce_function(spark, sf_dir):
    """O-18 / O-32: a user's reduce of (1, event, user) tuples per event type, merged per task."""
    ev = _events(spark, sf_dir, "event_type", "event_id", "user_id").withColumn("n", F.lit(1).cast("bigint"))
    return table_functions.reduce_function(ev, ["event_type"], ["n", "event_id", "user_id"],
                                           lambda a, b: (a[0] + b[0], max(a[1], b[1]), min(a[2], b[2])))
