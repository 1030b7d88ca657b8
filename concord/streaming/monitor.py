"""What a running stream tells about itself: its backlog and lateness, and a flag to fall back to polling."""

from __future__ import annotations

import json
import threading
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql.streaming.listener import StreamingQueryListener


@dataclass(frozen=True)
class Lag:
    """Of one progress report: input rows; outstanding bytes and offsets of the sources that report them; seconds behind event time,
    of streams with a watermark."""

    query: str
    batch: int
    rows: int
    bytes: int
    offsets: int
    behind: float | None


def _seconds(text: str) -> float:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp()


def lag_of(progress: dict[str, Any]) -> Lag:
    """From a progress report's JSON."""
    total = lambda name: sum(int((s.get("metrics") or {}).get(name) or 0) for s in progress.get("sources", []))
    newest = (progress.get("eventTime") or {}).get("max")
    behind = _seconds(progress["timestamp"]) - _seconds(newest) if newest else None
    return Lag(progress.get("name") or progress["id"], progress["batchId"], int(progress.get("numInputRows") or 0), total("numBytesOutstanding"), total("maxOffsetsBehindLatest"), behind)


@dataclass
class LagMonitor(StreamingQueryListener):
    """Raises ``fallback`` for a query whose backlog exceeds a limit, or that ends with an error, and lowers it once it is at most half of it.

    ``most_bytes``, ``most_offsets`` and ``most_behind`` (seconds behind event time) are limits; None means none. Add it with
    ``spark.streams.addListener``. ``fallback(query)`` and ``lag(query)`` may be asked at any time.
    """

    most_bytes: int | None = None
    most_offsets: int | None = None
    most_behind: float | None = None
    _lags: dict[str, Lag] = field(default_factory=dict)
    _raised: dict[str, bool] = field(default_factory=dict)
    _names: dict[str, str] = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    def _over(self, lag: Lag, share: float) -> bool:
        pairs = ((lag.bytes, self.most_bytes), (lag.offsets, self.most_offsets), (lag.behind, self.most_behind))
        return any(most is not None and found is not None and found > share * most for found, most in pairs)

    def seen(self, lag: Lag) -> None:
        with self._lock:
            self._lags[lag.query] = lag
            raised = self._raised.get(lag.query, False)
            self._raised[lag.query] = self._over(lag, 0.5 if raised else 1.0)

    def fallback(self, query: str) -> bool:
        with self._lock:
            return self._raised.get(query, False)

    def lag(self, query: str) -> Lag | None:
        with self._lock:
            return self._lags.get(query)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        self.seen(lag_of(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            with self._lock:
                self._raised[self._names.get(str(event.id), str(event.id))] = True
