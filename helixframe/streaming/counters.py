"""Row counters of streams: what each batch of a running query observes, added up."""

from __future__ import annotations

from threading import Condition

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(rows: DataFrame, name: str, **more: Column) -> DataFrame:
    """A stream's `rows`, of which each batch tells n_rows and `more` (sums or counts by name) under `name`."""
    return rows.observe(name, F.count(F.lit(1)).alias("n_rows"), *[c.alias(k) for k, c in more.items()])


class StreamCounters(StreamingQueryListener):
    """The sums of all batches by the name of the counter, of the queries that run while this listens.

    Batches are told apart by run and number, so that one that is told twice counts once. Sums are a few numbers a counter,
    whatever the length of the stream.
    """

    def __init__(self) -> None:
        self._sums: dict[str, dict[str, int]] = {}
        self._last: dict[str, int] = {}
        self._ended: set[str] = set()
        self._told = Condition()

    def onQueryStarted(self, event) -> None:
        """Nothing to count yet."""

    def onQueryIdle(self, event) -> None:
        """No rows have come."""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._told:
            run, batch = str(progress.runId), progress.batchId
            if batch <= self._last.get(run, -1):
                return
            self._last[run] = batch
            for name, row in progress.observedMetrics.items():
                own = self._sums.setdefault(name, {})
                for key, value in row.asDict().items():
                    own[key] = own.get(key, 0) + (value or 0)

    def onQueryTerminated(self, event) -> None:
        with self._told:
            self._ended.add(str(event.runId))
            self._told.notify_all()

    def sums(self, query, seconds: float = 60) -> dict[str, dict[str, int]]:
        """All sums once `query`, which has ended, has told its last batch; an error if it doesn't in so many seconds."""
        with self._told:
            if not self._told.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError("the query hasn't told of its end")
            return {name: dict(own) for name, own in self._sums.items()}
