"""tideline: event-stream analytics operators on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from the
DataFrame / SQL API so Catalyst can prune, push down and pick the physical
strategy.  Where an operator has a streaming form it lives in
``tideline.streaming``; batch forms live in ``tideline.operators``.
"""

import sys as _sys

# Python-side pieces (pandas UDFs, mapInPandas, transformWithState processors)
# are shipped to workers by value, so executors and Spark's planning-time
# Python runners need no copy of this package on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - very old pyspark
    pass

from tideline.session import get_session, checkpoint_dir  # noqa: E402,F401

__all__ = ["get_session", "checkpoint_dir"]
