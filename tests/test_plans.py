"""Plan-level checks: what the optimizer makes of the registered queries."""

import __spark_entry__ as E
from conftest import SF_SMALL
from tideline.plans import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(spark):
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue  # these run a stream when called; their operators are covered in test_streaming
        p = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_pushdown_pruning_and_group_limit(spark):
    q = E.queries()
    p = _plan(q["sql_filter_purchases"](spark, SF_SMALL))
    assert "EqualTo(event_type,purchase)" in p
    assert "props" not in p.split("ReadSchema:")[1].split("\n")[0]
    assert "WindowGroupLimit" in _plan(q["sliding_top2_event_types"](spark, SF_SMALL))
    assert "WindowGroupLimit" in _plan(q["first5_average_ts"](spark, SF_SMALL))
    # partial aggregation before the shuffle for windowed counts
    assert "partial_count" in _plan(q["tumbling_count_per_user"](spark, SF_SMALL))
