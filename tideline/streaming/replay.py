"""Replay a table as a file stream (O-04) and run bounded streaming queries.

``replay_to_files`` cuts a DataFrame into ``n_files`` parquet folders in
arrival order; ``read_replay`` streams them one file per micro-batch, so
the watermark advances between batches as it would on a live feed."""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



TARGET_FILE_ROWS = 1_000_000


def replay_to_files(df: DataFrame, out_dir: str, n_files: int, order: str, files_per_part: int = 4) -> list[str]:
    """Write ``df`` as ``n_files`` consecutive parts of the integer ``order``
    range into one folder — one write job per part, so every file of part i
    is older than every file of part i+1 (the file source streams oldest
    first).  Each part is a range of integers, so the filter is pushed into the
    parquet scan; rows without an order value come last.  A part is written
    as at least ``files_per_part`` files of about ``TARGET_FILE_ROWS`` rows; read
    with the same number of files per trigger it is one micro-batch.
    Returns the folder as a one-element list (``read_replay`` streams it)."""
    return [_write_parts(df, out_dir, n_files, order, files_per_part)[0]]


def replay(df: DataFrame, out_dir: str, n_files: int, order: str) -> DataFrame:
    """``df`` as a stream of ``n_files`` micro-batches in ``order``."""
    folder, files = _write_parts(df, out_dir, n_files, order, 4)
    return read_replay(df.sparkSession, folder, df.schema, files)


def _write_parts(df: DataFrame, out_dir: str, n_files: int, order: str, files_per_part: int) -> tuple[str, int]:
    lo, hi, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    landing = os.path.join(out_dir, "replay")
    files = max(files_per_part, -(-n // (n_files * TARGET_FILE_ROWS)))
    if n == 0:
        return landing, files
    cuts = [None, None] if lo is None else [lo + (hi - lo + 1) * i // n_files for i in range(n_files + 1)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        cond = F.lit(False) if a is None else (F.col(order) >= F.lit(int(a))) & (F.col(order) < F.lit(int(b)))
        if i == len(cuts) - 2:
            cond = cond | F.col(order).isNull()
        # one part = one micro-batch, so the order of rows inside the part
        # does not matter: plain round-robin files
        df.where(cond).repartition(files).write.mode("append").parquet(landing)
    return landing, files


def read_replay(spark: SparkSession, folder: str, schema, files_per_trigger: int = 4) -> DataFrame:
    """Stream a replay folder oldest file first, about one part per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                 .parquet(folder))


@contextlib.contextmanager
def only_data_batches(spark: SparkSession) -> Iterator[None]:
    """Queries started within run no micro-batch without input (a query copies its settings when it starts).  State
    on processing time asks for such batches without end, so that ``availableNow`` wouldn't come to one."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, empty_batches: bool = True) -> None:
    """Run a streaming DataFrame over all available input into a parquet folder
    (append mode): output and checkpoint live on shared storage, a restart
    resumes exactly once.  Runs until all input is read, however long that takes.
    State on processing time needs ``empty_batches=False``."""
    with contextlib.nullcontext() if empty_batches else only_data_batches(df.sparkSession):
        q = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
               .outputMode("append").trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
