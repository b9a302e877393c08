"""Hysteresis per entity over a stream, with dwell and expiry by event time.

Samples may arrive late and in any order: an entity keeps its settled state (all events up to
the watermark, folded) and the events beyond it, at most those of the allowed lateness. Its
newest state is the fold of both, by (instant, tie), so arrival decides nothing. A timer wakes
an entity that has been inside for the dwell, or has been silent for the expiry. Rows leave
only where an entity's state has changed (update mode).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processor travels to executors by value: a cluster need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTER, LEAVE = 1, 0
_STATE = "inside boolean, since long, settled_to long, newest long, shown_inside boolean, shown_held boolean, wake long"
_OUT = "inside boolean, since long, held boolean, expired boolean"


def fold(inside: bool, since: int | None, events: list[tuple[int, int, int]]) -> tuple[bool, int | None]:
    """State after events (at, tie, enter or leave) in their order: inside, and since when."""
    for at, _, event in sorted(events):
        if (event == ENTER) != inside:
            inside, since = event == ENTER, at if event == ENTER else None
    return inside, since


class LatchProcessor(StatefulProcessor):
    """Times are microseconds, timers milliseconds."""

    def __init__(self, keys: list[str], dwell_ms: int | None, expiry_ms: int | None):
        self.keys, self.dwell_ms, self.expiry_ms = keys, dwell_ms, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)
        self.pending = handle.getListState("pending", "at long, tie long, event int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.get() if self.state.exists() else None
        inside, since, settled_to, newest, *shown, wake = known or (False, None, -(1 << 62), -(1 << 62), None, None, None)
        pending = [tuple(e) for e in self.pending.get()] if self.pending.exists() else []
        for row in rows:
            if row._at > settled_to:
                newest = max(newest, row._at)
                if row._event is not None:
                    pending.append((row._at, row._tie, row._event))
        watermark = timerValues.getCurrentWatermarkInMs()
        yield from self._settled(key, watermark, inside, since, settled_to, newest, shown, wake, pending)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        inside, since, settled_to, newest, *shown, _ = self.state.get()
        pending = [tuple(e) for e in self.pending.get()] if self.pending.exists() else []
        watermark = timerValues.getCurrentWatermarkInMs()
        if self.expiry_ms is not None and newest + 1000 * self.expiry_ms <= 1000 * watermark:
            self.state.clear()
            self.pending.clear()
            yield Row(**dict(zip(self.keys, key, strict=True)), inside=False, since=None, held=False, expired=True)
            return
        yield from self._settled(key, watermark, inside, since, settled_to, newest, shown, None, pending)

    def _settled(self, key, watermark, inside, since, settled_to, newest, shown, wake, pending) -> Iterator[Row]:
        """Fold what the watermark has passed, keep the rest, set the timer, and show the newest state if it is another."""
        to = max(settled_to, 1000 * watermark)
        inside, since = fold(inside, since, [e for e in pending if e[0] <= to])
        pending = [e for e in pending if e[0] > to]
        now, now_since = fold(inside, since, pending)
        held = bool(now and self.dwell_ms is not None and now_since + 1000 * self.dwell_ms <= 1000 * watermark)

        due = [now_since // 1000 + self.dwell_ms] if now and not held and self.dwell_ms is not None else []
        if self.expiry_ms is not None:
            due.append(-(-newest // 1000) + self.expiry_ms)
        next_wake = min(due, default=None)
        if next_wake != wake:
            if wake is not None:
                self.handle.deleteTimer(wake)
            if next_wake is not None:
                self.handle.registerTimer(next_wake)
        self.state.update((inside, since, to, newest, now, held, next_wake))
        if pending:
            self.pending.put([tuple(e) for e in pending])
        else:
            self.pending.clear()
        if [now, held] != shown:
            yield Row(**dict(zip(self.keys, key, strict=True)), inside=now, since=now_since, held=held, expired=False)


def online_latch(
    stream: DataFrame, keys: Sequence[str], event: Column, tie: Column, ts: str = "ts", lateness: str = "1 hour",
    dwell_seconds: int | None = None, expiry_seconds: int | None = None,
) -> DataFrame:
    """(keys, inside, since, held, expired) of every entity whose state has changed; update mode.

    ``event`` is 1 where a sample enters, 0 where it leaves, NULL where it does neither; ``tie``
    (an integer) orders samples of one instant. An entity is outside until it enters, is held
    when it has been inside for ``dwell_seconds``, and is forgotten (``expired``) when
    it has had no sample for ``expiry_seconds``.
    """
    watched = stream.withWatermark(ts, lateness).select(
        *keys, ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), tie.cast("long").alias("_tie"), event.cast("int").alias("_event"))
    ms = [None if s is None else 1000 * s for s in (dwell_seconds, expiry_seconds)]
    types = [f"{f.name} {f.dataType.simpleString()}" for f in watched.schema if f.name in keys]
    changed = watched.groupBy(*keys).transformWithState(LatchProcessor(list(keys), *ms), ", ".join([*types, _OUT]), "Update", "EventTime")
    return changed.withColumn("since", F.timestamp_micros("since"))
