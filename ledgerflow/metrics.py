"""Named metrics collected while a frame is written or streamed."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery


def counter(condition: Column | None = None) -> Column:
    """Rows, or rows that meet a condition."""
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


def distribution(name: str, value: Column) -> dict[str, Column]:
    """Count, minimum, maximum and mean of a value, named ``name_count`` and so on."""
    return {
        f"{name}_count": F.count(value),
        f"{name}_min": F.min(value),
        f"{name}_max": F.max(value),
        f"{name}_mean": F.avg(value),
    }


def observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, Observation | None]:
    """Attach metrics to a frame.

    A batch frame returns an observation that is filled by the next action; a streaming frame reports under ``name`` in
    the progress of its query.
    """
    exprs = [expr.alias(label) for label, expr in metrics.items()]
    if df.isStreaming:
        return df.observe(name, *exprs), None
    observation = Observation(name)
    return df.observe(observation, *exprs), observation


def combined(parts: list[dict]) -> dict:
    """The metrics of several batches as those of all their rows.

    Counters add up. Of a ``distribution`` the minimum, the maximum and the mean by count are taken; a batch without
    values has none to add.
    """
    names = list(dict.fromkeys(name for part in parts for name in part))
    found: dict = {}
    for name in names:
        label, _, kind = name.rpartition("_")
        values = [part[name] for part in parts if part.get(name) is not None]
        if kind in ("min", "max") and f"{label}_count" in names:
            found[name] = (min if kind == "min" else max)(values, default=None)
        elif kind == "mean" and f"{label}_count" in names:
            pairs = [(part[name], part[f"{label}_count"]) for part in parts if part.get(name) is not None]
            total = sum(n for _, n in pairs)
            found[name] = sum(mean * n for mean, n in pairs) / total if total else None
        else:
            found[name] = sum(values)
    return found


class StreamTotals(StreamingQueryListener):
    """Adds up the observed metrics of streaming queries over their micro-batches.

    A batch that runs again after a restart replaces what it reported before. Only totals and the last batch of each
    query are held, however long it runs.
    """

    def __init__(self) -> None:
        super().__init__()
        self._lock = threading.Condition()
        self._totals: dict[str, dict[str, dict]] = {}
        self._last: dict[str, tuple[int, dict[str, dict]]] = {}
        self._ended: set[str] = set()

    @classmethod
    def listening(cls, spark: SparkSession) -> StreamTotals:
        """A listener that a session's queries report to from now on."""
        found = cls()
        spark.streams.addListener(found)
        return found

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = {name: row.asDict() for name, row in (progress.observedMetrics or {}).items()}
        if metrics:
            self.add(str(progress.id), progress.batchId, metrics)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def add(self, query_id: str, batch_id: int, metrics: dict[str, dict]) -> None:
        """Take the metrics that a query's batch reports."""
        with self._lock:
            last = self._last.get(query_id)
            if last is not None and last[0] != batch_id:
                totals = self._totals.setdefault(query_id, {})
                for name, found in last[1].items():
                    totals[name] = combined([totals[name], found]) if name in totals else found
            self._last[query_id] = (batch_id, metrics)

    def of(self, query: StreamingQuery, name: str, timeout: float = 30.0) -> dict:
        """The totals of a query's metrics; of a query that has ended, after its last report has arrived."""
        with self._lock:
            if not query.isActive:
                self._lock.wait_for(lambda: str(query.runId) in self._ended, timeout)
            query_id = str(query.id)
            known = self._totals.get(query_id, {}).get(name)
            last = self._last.get(query_id, (0, {}))[1].get(name)
            return combined([part for part in (known, last) if part is not None])
