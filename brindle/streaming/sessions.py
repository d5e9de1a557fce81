"""Sessions of a stream, kept in a state store, closed by timers in event time."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Of each session: user, first and last event in microseconds, events; ``late``: one row that was on its way for too long.
SESSIONS = "user_id long, first long, last long, n long, late boolean"
FOUND = Row("user_id", "first", "last", "n", "late")
#: Rows that are held before they are merged, at least.
CHUNK = 1024
#: The state: open sessions, three numbers each, as 64-bit integers in one value. One read and one write a key and batch, however many they are.
OPEN = "open binary"


class Sessions(StatefulProcessor):
    """For a key, its open sessions, apart by ``gap`` or more. A row joins all sessions within the gap of it, which become one. Sessions that are over by the
    watermark are emitted and forgotten, when rows come for the key or else by the key's one timer, which stands where the first of its sessions is
    over. Late rows are emitted as they are.

    Between two batches the state holds what may still grow: sessions that ended less than gap before the watermark. A key has few of these at a
    time, however many rows it has."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        spans = self.stored()
        before = self.timer(spans)
        held = len(spans)
        for row in rows:
            if row.late:
                yield FOUND(key[0], row.at, row.at, 1, True)
            else:
                spans.append((row.at, row.at, 1))
                if len(spans) >= 2 * held + CHUNK:  # so that a key's rows of one batch are never all held
                    spans = self.merged(spans)
                    held = len(spans)
        yield from self.closed(key, self.merged(spans), before, timerValues.getCurrentWatermarkInMs())

    def stored(self) -> list[tuple[int, int, int]]:
        value = self.open.get()
        flat = array("q", value[0] if value else b"").tolist()
        return list(zip(flat[::3], flat[1::3], flat[2::3]))

    def merged(self, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        for first, last, n in sorted(spans):
            if out and first - out[-1][1] < self.gap:
                out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
            else:
                out.append((first, last, n))
        return out

    def over(self, last: int) -> int:
        """The first millisecond at which a session cannot grow."""
        return -(-(last + self.gap) // 1000)

    def timer(self, spans: list[tuple[int, int, int]]) -> int | None:
        return min((self.over(last) for _, last, _ in spans), default=None)

    def closed(self, key: tuple, spans: list[tuple[int, int, int]], before: int | None, mark: int) -> Iterator[Row]:
        """Emit what is over by the watermark and put the rest into the state; ``before`` is the timer that is set, if any."""
        left = [x for x in spans if self.over(x[1]) > mark]
        if left:
            self.open.update((array("q", [n for x in left for n in x]).tobytes(),))
        else:
            self.open.clear()
        after = self.timer(left)
        if after != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        for x in spans:
            if self.over(x[1]) <= mark:
                yield FOUND(key[0], *x, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.closed(key, self.stored(), None, timerValues.getCurrentWatermarkInMs())  # Spark deletes the timer that has fired

    def close(self) -> None:
        pass


def sessions(events: DataFrame, gap: timedelta, lateness: timedelta) -> DataFrame:
    """SESSIONS of a stream of (user_id, at, arrived): each is emitted once, when all rows that could join it must have arrived.

    ``at`` is a row's time in microseconds, ``arrived`` the timestamp of its arrival, which the watermark follows by ``lateness``. A row that took
    longer than that is late, and emitted as such: which rows are late does not depend on how the stream is cut into batches, as it
    would if the watermark followed ``at``, and no row is dropped, as Spark drops what lies behind the watermark. Rows must be read about in the order of
    their arrival; files are."""
    most = int(lateness.total_seconds() * 1_000_000)
    rows = events.select("user_id", "at", "arrived", (F.unix_micros("arrived") - F.col("at") > most).alias("late"))
    rows = rows.withWatermark("arrived", f"{most} microseconds")
    return rows.groupBy("user_id").transformWithState(Sessions(int(gap.total_seconds() * 1_000_000)), SESSIONS, "Append", "EventTime")
