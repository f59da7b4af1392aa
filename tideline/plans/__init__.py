"""Named queries over the driver's tables: each binds operators to the
``events`` / ``orders`` / ``lineitem`` tables and carries its DuckDB SQL."""

from tideline.plans.registry import QUERIES, ORACLE_SQL, register  # noqa: F401
from tideline.plans import event_windows, event_rows, event_joins, event_patterns, event_streams  # noqa: F401,E402
