"""Session helpers.

The library never assumes a particular cluster; it only reads settings from
the session it is given.  ``get_session`` is a convenience for tests, the
bench and local runs.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tideline") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDELINE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster, from ``spark.checkpoint.dir`` (a
    setting the session is started with) or the context's checkpoint folder.

    A session without either gets a fresh folder only in local mode, where all
    tasks share this machine's disk (tests); elsewhere that is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("start the session with spark.checkpoint.dir set to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tideline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d
