"""Throughput and readiness of running streams, from the progress Spark reports per batch."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

ROWS = "rows_seen"


def observed(rows: DataFrame, **metrics) -> DataFrame:
    """Count the rows of every micro-batch, and further aggregates on request, as they pass."""
    return rows.observe(ROWS, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])


@dataclass(frozen=True)
class BatchReport:
    """One micro-batch: what came in, what passed the observed place, how fast."""

    name: str
    batch_id: int
    input_rows: int
    rows: int | None
    seconds: float
    metrics: dict = field(default_factory=dict, compare=False)

    @property
    def rows_per_second(self) -> float:
        return self.input_rows / self.seconds if self.seconds else 0.0


class StreamProgress(StreamingQueryListener):
    """Keeps the last reports of every query of a session.

    Reports come by the listener bus, so no batch is held up and no row is counted twice.
    Queries are told apart by name. Only the newest ``keep`` reports of a query are kept,
    totals go on.
    """

    def __init__(self, keep: int = 1000):
        self.keep = keep
        self.reports: dict[str, list[BatchReport]] = {}
        self.total_rows: dict[str, int] = {}
        self.ended: dict[str, str | None] = {}
        self._names: dict[str, str] = {}
        self._changed = threading.Condition()

    def attach(self, spark: SparkSession) -> "StreamProgress":
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        seen = progress.observedMetrics.get(ROWS)
        metrics = seen.asDict() if seen is not None else {}
        seconds = progress.durationMs.get("triggerExecution", 0) / 1000
        report = BatchReport(name, progress.batchId, progress.numInputRows, metrics.get("rows"), seconds, metrics)
        with self._changed:
            held = self.reports.setdefault(name, [])
            held.append(report)
            del held[: -self.keep]
            self.total_rows[name] = self.total_rows.get(name, 0) + report.input_rows
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.ended[self._names.get(str(event.runId), str(event.id))] = event.exception
            self._changed.notify_all()

    def throughput(self, name: str) -> dict[str, float]:
        """Rows, seconds and rows per second over the reported batches of a query."""
        with self._changed:
            reports = list(self.reports.get(name, []))
        rows, seconds = sum(r.input_rows for r in reports), sum(r.seconds for r in reports)
        return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else 0.0}

    def await_rows(self, names: list[str], seconds: float) -> bool:
        """True as soon as every named query has taken in a row, False when time is up."""
        with self._changed:
            return self._changed.wait_for(lambda: all(self.total_rows.get(n, 0) > 0 for n in names), seconds)

    def await_end(self, queries: list[StreamingQuery], seconds: float) -> bool:
        """True once the end of all these queries, and with it their last report, is known."""
        names = [q.name or str(q.id) for q in queries]
        with self._changed:
            return self._changed.wait_for(lambda: all(n in self.ended for n in names), seconds)
