"""Streaming sinks (O-07, O-08, O-53), the streaming late-data split (O-54) and durable arrival times (O-43)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import duration_us, epoch_us, ntz_from_us
from tideline.operators.route import add_route
from tideline.operators.ordering import global_index, prefix_max_before


def _read_if_exists(spark, path: str):
    """Read a parquet folder on any Hadoop-compatible file system, or None."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def rolling_file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                      roll_interval: str | None = "15 minutes", max_records_per_file: int = 1_000_000,
                      partition_by: list[str] | None = None, available_now: bool = False):
    """O-07: files roll per trigger interval (age) and per
    ``max_records_per_file`` (size); exactly-once via the checkpoint.
    ``available_now`` processes what is there and stops (tests, backfills)."""
    w = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
           .option("maxRecordsPerFile", max_records_per_file))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=roll_interval)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


def side_outputs_sink(df: DataFrame, rules: list, path: str, checkpoint: str, default: str = "main",
                      available_now: bool = False):
    """O-28: every route of a stream in one pass, a folder ``route=<name>`` each
    (first matching rule wins); a reader of one folder sees one output only."""
    routed = add_route(df, rules, default)
    return rolling_file_sink(routed, path, checkpoint, partition_by=["route"], available_now=available_now)


def buffered_batches_sink(df: DataFrame, order: str, n: int, out_path: str, state_path: str,
                          checkpoint: str, available_now: bool = True):
    """O-08 on a stream: rows are released in groups of exactly ``n`` in
    ``order``; the incomplete rest is carried to the next micro-batch through
    a per-epoch table next to the checkpoint.  Each epoch writes only its own
    folders (overwrite), so a replayed epoch after a failure is idempotent."""
    def per_batch(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        prev = os.path.join(state_path, f"epoch={epoch - 1}")
        carry = _read_if_exists(spark, prev) if epoch > 0 else None
        rows = batch.unionByName(carry) if carry is not None else batch
        d = global_index(rows, order, col="_idx", total_col="_n")
        full = F.floor(F.col("_n") / F.lit(n)) * F.lit(n)
        d = d.withColumn("_full", full).persist()
        (d.where(F.col("_idx") < F.col("_full"))
          .withColumn("batch_in_epoch", F.floor(F.col("_idx") / F.lit(n)).cast("bigint"))
          .withColumn("epoch", F.lit(epoch)).drop("_idx", "_n", "_full")
          .write.mode("overwrite").parquet(os.path.join(out_path, f"epoch={epoch}")))
        (d.where(F.col("_idx") >= F.col("_full")).drop("_idx", "_n", "_full")
          .write.mode("overwrite").parquet(os.path.join(state_path, f"epoch={epoch}")))
        d.unpersist()

    w = df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def late_split_sink(df: DataFrame, ts: str, arrival: str, size: str, delay: str, out_path: str,
                    state_path: str, checkpoint: str, available_now: bool = True):
    """O-54 on a stream: rows whose tumbling window had closed when they
    arrived go to ``out_path/route=late``, the rest to ``route=on_time``.
    The running max event time is kept per epoch next to the checkpoint."""
    sz, dl = duration_us(size), duration_us(delay)

    def per_batch(batch: DataFrame, epoch: int):
        spark = batch.sparkSession
        prev = os.path.join(state_path, f"epoch={epoch - 1}")
        prev_df = _read_if_exists(spark, prev) if epoch > 0 else None
        prev_max = prev_df.first()[0] if prev_df is not None else None
        d = batch.withColumn("_us", epoch_us(ts))
        d = prefix_max_before(d, arrival, "_us", col="_prev_max")
        if prev_max is not None:
            d = d.withColumn("_prev_max", F.greatest(F.col("_prev_max"), F.lit(prev_max)))
        w_us = F.floor(F.col("_us") / F.lit(sz)).cast("bigint") * F.lit(sz)
        late = F.coalesce((w_us + F.lit(sz)) <= (F.col("_prev_max") - F.lit(dl)), F.lit(False))
        out = (d.withColumn("window_end", ntz_from_us(w_us + F.lit(sz)))
                .withColumn("route", F.when(late, F.lit("late")).otherwise(F.lit("on_time"))).drop("_us", "_prev_max"))
        out.write.mode("overwrite").partitionBy("route").parquet(os.path.join(out_path, f"epoch={epoch}"))
        new_max = batch.agg(F.max(epoch_us(ts)).alias("m")).first()[0]
        vals = [x for x in (prev_max, new_max) if x is not None]
        m = max(vals) if vals else None
        spark.createDataFrame([(m,)], "m long").write.mode("overwrite").parquet(os.path.join(state_path, f"epoch={epoch}"))

    w = df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def upsert_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """O-53: an aggregated stream in update mode; each epoch writes the groups it changed into a folder of its own
    (overwrite), so a replayed epoch is idempotent.  ``latest_rows`` is the read side.  The watermark's delay is the
    allowed lateness: until it has passed a window, a late row updates the window's row instead of being lost."""
    def per_batch(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(os.path.join(path, f"epoch={epoch}"))

    w = df.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def latest_rows(updates: DataFrame, keys: list[str], epoch: str = "epoch") -> DataFrame:
    """The last written row of each key (null keys are a key) of a table of updates, without its epoch."""
    rest = [c for c in updates.columns if c not in (*keys, epoch)]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), epoch).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def stamped_sink(df: DataFrame, path: str, checkpoint: str, col: str = "arrived", available_now: bool = True):
    """O-43: rows with the time they arrived at (their micro-batch's, which Spark keeps in the checkpoint, so that a
    repeated micro-batch gets the same one), written once.  Windows on ``col`` of that table replay alike."""
    return rolling_file_sink(df.withColumn(col, F.current_timestamp()), path, checkpoint, available_now=available_now)
