"""Top-N per window on a stream with bounded state (O-70, O-71).

Items are counted per (window, item).  The counts of a closed window are dealt by hash of the
item to ``buckets`` groups, each of which hands on its best ``n`` (a heap of n entries, whatever
the number of items), and the window's last group holds at most ``n * buckets`` entries."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.time import duration_us, to_ntz
from tideline.streaming.ops import with_event_time
from tideline.streaming.stateful import keyed_state

DEFAULT_BUCKETS = 32


class BestOfBucket(StatefulProcessor):
    """The best n counts of a (window, bucket).  Append mode emits all counts of a window in the
    micro-batch that closes it, so a bucket's rows come in one call and need no state."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # nulls first, as in the ranking of the last step
        for cnt, _, item in heapq.nsmallest(self.n, ((-r.cnt, (r.item is not None, r.item if r.item is not None else 0), r.item) for r in rows)):
            yield Row(window_end=key[0], item=item, cnt=-cnt)

    def close(self) -> None:
        pass


def candidates(df: DataFrame, item: str, ts: str, size: str, slide: str | None, n: int, delay: str = "0 seconds",
               buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """(window_end, item, cnt): the best ``n`` of each of a window's ``buckets`` groups of items."""
    d = with_event_time(df, ts, delay)
    w = F.window("et", f"{duration_us(size)} microseconds", f"{duration_us(slide or size)} microseconds")
    counts = d.groupBy(F.col(item).alias("item"), w.alias("window")).agg(F.count(F.lit(1)).alias("cnt"))
    dealt = counts.select(F.col("window.end").alias("window_end"), F.pmod(F.xxhash64("item"), F.lit(buckets)).alias("bucket"), "item", "cnt")
    schema = f"window_end timestamp, item {df.schema[item].dataType.simpleString()}, cnt long"
    return keyed_state(dealt, BestOfBucket(n), schema, "EventTime", keys=["window_end", "bucket"], event_time="window_end")


def windowed_top_n(df: DataFrame, item: str, ts: str, size: str, slide: str | None, n: int, delay: str = "0 seconds",
                   buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """O-70 / O-71: the ``n`` items with most rows of each window (ties by item, nulls first), with their rank."""
    best = candidates(df, item, ts, size, slide, n, delay, buckets)
    packed = F.struct((-F.col("cnt")).alias("neg"), "item", "cnt")
    top = best.groupBy("window_end").agg(F.slice(F.sort_array(F.collect_list(packed)), 1, n).alias("_top"))
    start = F.timestamp_micros(F.unix_micros("window_end") - F.lit(duration_us(size)))
    return (top.select(to_ntz(start).alias("window_start"), to_ntz(F.col("window_end")).alias("window_end"), F.posexplode("_top").alias("_pos", "_e"))
               .select("window_start", "window_end", F.col("_e.item").alias(item), F.col("_e.cnt").alias("cnt"), (F.col("_pos") + 1).cast("bigint").alias("rn")))
