import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tideline.functions.time import ntz_from_ms  # noqa: E402
from tideline.session import checkpoint_dir, get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="tideline-tests")
    checkpoint_dir(s)
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tideline-test-")


def frame(spark, rows, schema, ms_col="ms", ts_col="ts"):
    """Fixture rows with an epoch-ms column turned into a TIMESTAMP_NTZ column."""
    df = spark.createDataFrame(rows, schema)
    if ms_col in df.columns:
        df = df.withColumn(ts_col, ntz_from_ms(ms_col))
    return df


def hm(h, m=0, s=0):
    """h:mm:ss on 1970-01-01 as epoch ms."""
    return ((h * 60 + m) * 60 + s) * 1000


def ntz(ms):
    import datetime
    return datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)


def rows_set(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


F  # re-export for tests
