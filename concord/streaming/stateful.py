"""Stateful processors of event rules: one state variable per kind of fact, read and written one entry per event.

State lies in RocksDB, keyed and partitioned by Spark; timers by event time forget keys and release what waits.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def processed(events: DataFrame, key: str, processor: StatefulProcessor, schema) -> DataFrame:
    """``events`` by key through a processor with event-time timers. Sets the session's state store to RocksDB, which these need."""
    spark: SparkSession = events.sparkSession
    spark.conf.set(PROVIDER, ROCKSDB)
    return events.groupBy(key).transformWithState(processor, schema, "append", "EventTime")


class _Timed(StatefulProcessor):
    """Keeps one timer per key."""

    def __init__(self):
        self.handle: StatefulProcessorHandle | None = None

    def _alarm(self, at_ms: int, before: int | None, timers) -> int:
        """Move the key's timer; a time that the watermark has passed becomes the next one that it has not."""
        at_ms = max(at_ms, timers.getCurrentWatermarkInMs() + 1)
        if before != at_ms:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(at_ms)
        return at_ms

    def close(self) -> None:
        pass


class Newest(_Timed):
    """Lets events through whose order exceeds all earlier ones of the key."""

    def __init__(self, order: str, columns: list[str], ttl_ms: int):
        super().__init__()
        self.order, self.columns, self.ttl_ms = order, columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "value long, seen long, timer long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, seen, timer = self.last.get() if self.last.exists() else (None, 0, None)
        out = Row(*self.columns)
        for row in sorted(rows, key=lambda r: r[self.order]):
            seen = max(seen, row["__ms"])
            if last is None or row[self.order] > last:
                last = row[self.order]
                yield out(*[row[c] for c in self.columns])
        self.last.update((last, seen, self._alarm(seen + self.ttl_ms, timer, timerValues)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        yield from ()


class Reorder(_Timed):
    """Releases events in order of sequence; those ahead wait in a map, one entry each."""

    def __init__(self, columns: list[str], most: int, timeout_ms: int, start: int, ttl_ms: int):
        super().__init__()
        self.columns, self.most, self.timeout_ms, self.start, self.ttl_ms = columns, most, timeout_ms, start, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "turn long, since long, seen long, waiting long, timer long")
        self.held = handle.getMapState("held", "sequence long", "payload string")

    def _flushed(self) -> list[tuple[int, str]]:
        """All that wait, in order; the map is empty afterwards."""
        found = sorted((n, text) for (n,), (text,) in self.held.iterator())
        self.held.clear()
        return found

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        turn, since, seen, waiting, timer = self.head.get() if self.head.exists() else (self.start, 0, 0, 0, None)
        out = Row(*self.columns)
        name, sequence, payload = self.columns
        for row in rows:
            n, text, now = row[sequence], row[payload], row["__ms"]
            seen = max(seen, now)
            if n < turn or (waiting and n != turn and self.held.containsKey((n,))):
                continue
            if n == turn:
                yield out(key[0], n, text)
                turn += 1
                while waiting and self.held.containsKey((turn,)):
                    yield out(key[0], turn, self.held.getValue((turn,))[0])
                    self.held.removeKey((turn,))
                    turn, waiting = turn + 1, waiting - 1
                since = now
            else:
                since = since if waiting else now
                self.held.updateValue((n,), (text,))
                waiting += 1
            if waiting and (waiting >= self.most or now - since >= self.timeout_ms):
                for n, text in self._flushed():
                    yield out(key[0], n, text)
                    turn = n + 1
                waiting = 0
        timer = self._alarm(since + self.timeout_ms if waiting else seen + self.ttl_ms, timer, timerValues)
        self.head.update((turn, since, seen, waiting, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.head.exists():
            return
        turn, since, seen, waiting, _ = self.head.get()
        if not waiting:
            self.head.clear()
            return
        out = Row(*self.columns)
        for n, text in self._flushed():
            yield out(key[0], n, text)
            turn = n + 1
        self.head.update((turn, since, seen, 0, self._alarm(seen + self.ttl_ms, None, timerValues)))
