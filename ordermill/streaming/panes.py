"""Firing panes of an event-time window, one state per (order, window).

A window fires early, ``early_s`` after the first element of a pane arrived,
on time when the clock passes its end, and late for every element after that
until it is too late.  Panes discard what has fired: a pane holds only what
came since the one before, and of a pane the copy that was ingested first
stays.  A pane that got nothing new gives no row.

The clock is the arrival time of the messages, so the panes follow from the
messages alone: a pane opens with the first copy not covered by an open pane,
and that copy is its earliest one, so it is given out at once.  The state is
the number of the last pane and the time it closes; an event-time timer removes
it when the watermark, which trails the clock by window and lateness, passes
the window's end: nothing of the window arrives in time any more.  A replayed
micro-batch starts from the state before it and gives the same panes.

Copies of one micro-batch are first reduced to one a distinct arrival time,
so a hot key costs memory by its arrival times (one, for a live source).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

EARLY, ON_TIME, LATE = "early", "on time", "late"
SECOND = 1_000_000
PANE_FIELDS = [StructField("pane", IntegerType()), StructField("firing", StringType())]


def next_pane(number: int, closes: int, arrival: int, window_end: int | None, early_us: int):
    """(number, closes, firing) of the pane that an element opens, or None when the
    open pane covers it.  Without a window (rejected messages) only the first opens one."""
    if number and (window_end is None or arrival < closes):
        return None
    if window_end is None:
        return 1, 0, None
    if arrival >= window_end:
        return number + 1, arrival + 1, LATE
    closes = min(arrival + early_us, window_end)
    return number + 1, closes, ON_TIME if closes == window_end else EARLY


class PaneProcessor(StatefulProcessor):
    """Rows with ``arrival``, ``window_end`` (microseconds, null for rejected messages) and ``tie``."""

    def __init__(self, early_s: int, columns: list[str]):
        self.early_us, self.columns = early_s * SECOND, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pane = handle.getValueState("pane", "number int, closes long, until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = {}
        for row in rows:
            held = first.get(row["arrival"])
            if held is None or row["tie"] < held["tie"]:
                first[row["arrival"]] = row
        state = self.pane.get() if self.pane.exists() else (0, 0, 0)
        number, closes, until = state
        needed = until
        for arrival in sorted(first):
            row = first[arrival]
            opened = next_pane(number, closes, arrival, row["window_end"], self.early_us)
            if opened is not None:
                number, closes, firing = opened
                yield Row(**{c: row[c] for c in self.columns}, pane=number, firing=firing)
            needed = max(needed, max(arrival, row["window_end"] or arrival) // 1000 + 1)
        if needed > until:
            self.handle.registerTimer(needed)
        self.pane.update((number, closes, needed))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.pane.exists() and expiredTimerInfo.getExpiryTimeInMs() >= self.pane.get()[2]:
            self.pane.clear()
        return iter([])

    def close(self) -> None:
        pass


def with_panes(rows: DataFrame, keys: list[str], watermark: str, early_s: int) -> DataFrame:
    """The rows that open a pane of their key, with ``pane`` and ``firing``;
    ``watermark`` is the column that carries the watermark."""
    columns = [c for c in rows.columns if c != watermark]
    rows = rows.withColumn("tie", F.xxhash64(*[c for c in columns if c not in ("arrival", "window_end")]))
    out = StructType([*[rows.schema[c] for c in columns], *PANE_FIELDS])
    return rows.groupBy(*keys).transformWithState(PaneProcessor(early_s, columns), out, "Append", "EventTime")
