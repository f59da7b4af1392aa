"""Two connected feeds with shared keyed state (O-31, O-46).

``two_feeds_stream`` pairs the rows of two feeds that share a key and lie at most ``wait``
apart in event time: every such pair once, as soon as both rows are there, and every row
without any partner once the watermark shows that none can come.  It is the streaming form of
``operators.joins.reconcile`` with state and timers of its own, for feeds that can't afford a
stream-stream join's copy of all rows, or that need more per pair than a join gives.

State: a row per open row of either feed, with a mark whether it was paired, in groups of keys (``groups``).  A
row's partners are a stretch of the other feed's rows in (key, time) order, found by binary search.  A group's timer
drops rows that can't be paired any more.  Null times take no part, and rows of a null key have no
partners (as in an equi-join)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import duration_us
from tideline.streaming.groups import DEFAULT_GROUPS, KeyGroups, codes, flagged, grouped_state
from tideline.streaming.stateful import with_watermark

#: Most pairs told in one frame, unless one row has more.
MAX_PAIRS = 200_000


class TwoFeeds(KeyGroups):
    """Each pair is told when its later row comes, each row without one when the watermark has passed it by ``wait``."""

    columns = ("k", "is_left", "ms", "id", "has_id", "paired")

    def __init__(self, wait_ms: int):
        self.wait = wait_ms

    def fresh(self, rows, now):
        return rows[rows["ms"] >= now].assign(paired=False)[list(self.columns)]  # the others are later than the watermark

    def _ranges(self, rows: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``right`` in (key, time) order, and for each row of ``left`` where its partners begin and end there."""
        code, ms = codes(rows), rows["ms"].to_numpy()
        times = np.unique(ms)
        first = code * (len(times) + 1)
        at = first + np.searchsorted(times, ms)
        right = right[np.argsort(at[right], kind="stable")]
        lo = first[left] + np.searchsorted(times, ms[left] - self.wait, "left")
        hi = first[left] + np.searchsorted(times, ms[left] + self.wait, "right")
        return right, np.searchsorted(at[right], lo, "left"), np.searchsorted(at[right], hi, "left")

    @staticmethod
    def _told(rows: pd.DataFrame, left: np.ndarray, right: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pd.DataFrame]:
        k, ids, has = (rows[c].to_numpy() for c in ("k", "id", "has_id"))
        n = hi - lo
        cut = (np.cumsum(n) - n) // MAX_PAIRS
        for part in np.split(np.arange(len(left)), np.flatnonzero(np.diff(cut)) + 1):
            m = n[part]
            i = np.repeat(left[part], m)
            j = right[np.repeat(lo[part] - (np.cumsum(m) - m), m) + np.arange(m.sum())]
            yield pd.DataFrame({"k": k[i], "l_id": ids[i], "has_l_id": has[i], "r_id": ids[j], "has_r_id": has[j], "status": "matched"})

    def advance(self, rows, known, now):
        is_left, keyed, new = rows["is_left"].to_numpy(), (rows["k"] != "0").to_numpy(), np.arange(len(rows)) >= known
        paired, out = rows["paired"].to_numpy().copy(), []
        for left, right in ((is_left & new, ~is_left), (is_left & ~new, ~is_left & new)):
            left, right = np.flatnonzero(left & keyed), np.flatnonzero(right & keyed)
            if len(left) and len(right):
                right, lo, hi = self._ranges(rows, left, right)
                paired[left] |= hi > lo
                reached = np.bincount(lo, minlength=len(right) + 1) - np.bincount(hi, minlength=len(right) + 1)
                paired[right] |= np.cumsum(reached)[:-1] > 0
                out.append(self._told(rows, left, right, lo, hi))
        rows = rows.assign(paired=paired)
        due = rows["ms"] + self.wait + 1  # the first watermark at which no partner can come
        lost, rest = rows[(due <= now) & ~rows["paired"]], rows[due > now]
        if len(lost):
            out.append([pd.DataFrame({"k": lost["k"], "l_id": lost["id"], "has_l_id": lost["has_id"] & lost["is_left"],
                                      "r_id": lost["id"], "has_r_id": lost["has_id"] & ~lost["is_left"],
                                      "status": np.where(lost["is_left"], "right_missing", "left_missing")})])
        return (f for frames in out for f in frames), rest, int(due[due > now].min()) if len(rest) else None


def two_feeds_stream(left: DataFrame, right: DataFrame, key: str, ts: str, id_col: str, wait: str,
                     delay: str = "0 seconds", groups: int = DEFAULT_GROUPS) -> DataFrame:
    """O-31 / O-46: k, l_id, r_id, status (matched, right_missing, left_missing) of two feeds with the
    same column names.  Rows may arrive in any order up to ``delay`` behind the latest time of either feed."""
    both = left.withColumn("is_left", F.lit(True)).unionByName(right.withColumn("is_left", F.lit(False)))
    d = with_watermark(both, key, ts, delay, [*flagged(id_col, "long", "id", 0), "is_left"])
    return grouped_state(d, TwoFeeds(duration_us(wait) // 1000),
                         "l_id long, has_l_id boolean, r_id long, has_r_id boolean, status string", groups)
