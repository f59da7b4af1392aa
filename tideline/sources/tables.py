"""Reading the parquet tables (O-02 for parquet) with explicit column pruning
left to Catalyst: callers select columns and filters are pushed into the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Names of the driver's test tables.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
