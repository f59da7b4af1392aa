"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline.session import checkpoint_dir

#: Text bytes handled at once inside a task; longer single texts form a slice of their own.
SLICE_BYTES = 1 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, a lost
    executor loses nothing, and the planner sees the table's true size."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``materialise`` has written, once whatever reads it has been written too."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def keep_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition on computed columns.  A plain filter is pushed below the projections
    that compute them, with their expressions copied into it, inside lambdas once per element."""
    once = F.when(condition, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return df.withColumn("__kept", F.explode(once)).drop("__kept")


class Shared:
    """A broadcast object of this package's classes.  A plain broadcast names them by module, so that every worker
    would need the package on its path; this one carries the classes with the bytes, and a task makes its object once."""

    def __init__(self, spark: SparkSession, value: object):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self) -> dict:
        return {"packed": self.packed}

    @property
    def value(self) -> object:
        if "made" not in self.__dict__:
            self.made = pickle.loads(self.packed.value)
        return self.made


#: Rows of an Arrow batch where a row has a whole text.
TEXT_ROWS = 1_000


def narrow_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``TEXT_ROWS``: 10,000 rows with whole texts take tens of
    MB on both sides of every Python worker, which small executors don't have.  Changes no result."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key) or 0)
    if now <= 0 or now > TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def give_back_memory() -> None:
    """Return freed memory to the system.  Python workers live on between tasks and share their
    executor's memory, and neither Arrow nor the C allocator does this by itself."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not this C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``max_bytes`` of ``column``."""
    give_back_memory()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = (np.cumsum(sizes) - sizes) // max_bytes
        cuts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]).tolist() + [n]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    batch = None
    give_back_memory()


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings, null as ''."""
    return [t or "" for t in batch.column(column).to_pylist()]


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column as UTF-8 bytes, null as b''."""
    col = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [t or b"" for t in col.cast(kind).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply) over uint64 arrays."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
