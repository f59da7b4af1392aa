"""Event-time helpers (O-60…O-64).

Test tables carry ``TIMESTAMP_NTZ``.  All arithmetic here is done on epoch
microseconds of the wall-clock value so results never depend on the session
time zone; ``event_time`` converts to ``TIMESTAMP`` only where Structured
Streaming demands it (watermarks), again without consulting the time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Unit names accepted in duration strings and their length in microseconds.
_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "ms": 1_000, "second": 1_000_000, "s": 1_000_000,
    "minute": 60_000_000, "min": 60_000_000, "hour": 3_600_000_000, "h": 3_600_000_000,
    "day": 86_400_000_000, "d": 86_400_000_000, "week": 7 * 86_400_000_000,
}


def duration_us(d: str | int) -> int:
    """'10 seconds' / '6 hours' / '15 min' -> microseconds (ints pass through)."""
    if isinstance(d, int):
        return d
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+?)s?\s*", d)
    if not m or m.group(2).lower() not in _UNITS_US:
        raise ValueError(f"bad duration {d!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2).lower()]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts: str | Column) -> Column:
    """Microseconds since epoch of a TIMESTAMP_NTZ (or TIMESTAMP) column."""
    # timestampdiff on NTZ values is time-zone free.
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts))


def epoch_ms(ts: str | Column) -> Column:
    return F.floor(epoch_us(ts) / F.lit(1000)).cast("bigint")


def ntz_from_us(us: str | Column) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us).cast("bigint"), F.expr(_EPOCH_NTZ))


def ntz_from_ms(ms: str | Column) -> Column:
    """O-64: epoch milliseconds -> event-time column (TIMESTAMP_NTZ)."""
    return ntz_from_us(_c(ms).cast("bigint") * F.lit(1000))


def event_time(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP (UTC instant) for watermarks, zone independent."""
    return F.timestamp_micros(epoch_us(ts))


def to_ntz(ts: str | Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock), zone independent."""
    return ntz_from_us(F.unix_micros(_c(ts)))
