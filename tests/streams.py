"""Streams over local fixture files."""

import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession


def stream_parts(spark: SparkSession, parts: list[str], schema, landing: str) -> DataFrame:
    """Copy each part's files into ``landing`` with increasing modification times and stream one file per trigger."""
    os.makedirs(landing, exist_ok=True)
    for i, p in enumerate(parts):
        if not os.path.isdir(p):
            continue
        for j, f in enumerate(sorted(x for x in os.listdir(p) if x.endswith(".parquet"))):
            dst = os.path.join(landing, f"part-{i:05d}-{j:03d}.parquet")
            shutil.copyfile(os.path.join(p, f), dst)
            t = 1_000_000_000 + i * 10 + j
            os.utime(dst, (t, t))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)


def run_to_memory(df: DataFrame, output_mode: str, checkpoint: str, timeout_s: int = 180,
                  name: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over all available input (``availableNow``)
    into a memory table and return that table (tests / small results)."""
    spark = df.sparkSession
    name = name or f"tl_{uuid.uuid4().hex[:10]}"
    q = (df.writeStream.format("memory").queryName(name).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        finished = q.awaitTermination(timeout_s)
        if not finished:
            raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
        if q.exception():
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
    return spark.table(name)
