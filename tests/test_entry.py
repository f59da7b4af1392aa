import os

import duckdb
import pandas as pd

import __spark_entry__ as E
from conftest import SF_SMALL
from tideline.plans import ORACLE_SQL, QUERIES
from tideline.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"event_type", "window_start", "window_end", "cnt", "rn"}
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(df):
    df = df[sorted(df.columns)].astype(str)
    return sorted(map(tuple, df.values.tolist()))


def test_sample_against_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    names = ["sliding_top2_event_types", "session_dynamic_gap", "cumulative_window_event_types",
             "interval_join_purchase_click", "three_errors_in_a_row", "periodic_pv_per_user", "changelog_count_per_user"]
    for n in names:
        a = E.queries()[n](spark, SF_SMALL).toPandas()
        b = con.sql(E.oracle_sql()[n]).df()
        for d in (a, b):
            for c in d.columns:
                if pd.api.types.is_datetime64_any_dtype(d[c]):
                    d[c] = d[c].astype("datetime64[us]")
        assert _norm(a) == _norm(b), n
