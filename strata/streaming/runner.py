"""Starting, bounding and measuring streaming queries.

A *triggered* run processes what is there when it starts and stops
(``availableNow``); a *continuous* run uses a processing-time trigger and, when
bounded (tests, one-shot jobs), stops once all input is processed.
"""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener


@dataclass
class RunResult:
    batches: int = 0
    input_rows: int = 0
    dropped_by_watermark: int = 0
    duration_ms: int = 0
    observed: dict = field(default_factory=dict)  # name -> summed metrics


class _Progress(StreamingQueryListener):
    """Sums every progress report of every run (a query object keeps only its latest)."""

    def __init__(self):
        self.runs: dict[str, RunResult] = defaultdict(RunResult)
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        res = self.runs[str(p.runId)]
        res.batches += 1
        res.input_rows += int(p.numInputRows or 0)
        for s in p.stateOperators or []:
            res.dropped_by_watermark += int(s.numRowsDroppedByWatermark or 0)
        for name, row in (p.observedMetrics or {}).items():
            acc = res.observed.setdefault(name, {})
            for k, v in row.asDict().items():
                acc[k] = acc.get(k, 0) + (v or 0)

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()


_LISTENERS: dict[str, _Progress] = {}


def _progress(spark: SparkSession) -> _Progress:
    """The listener of the session's application, added once."""
    key = f"{spark.sparkContext.applicationId}/{id(spark._jsparkSession)}"
    if key not in _LISTENERS:
        _LISTENERS[key] = _Progress()
        spark.streams.addListener(_LISTENERS[key])
    return _LISTENERS[key]


def start(spark: SparkSession, w: DataStreamWriter, continuous: bool = False, interval: str | None = None) -> StreamingQuery:
    """Start a triggered or continuous run whose progress is summed from its first report."""
    _progress(spark)
    w = w.trigger(processingTime=interval or "0 seconds") if continuous else w.trigger(availableNow=True)
    return w.start()


def await_run(spark: SparkSession, q: StreamingQuery, continuous: bool = False, timeout_s: float | None = None) -> RunResult:
    """Wait for a triggered run to end, or bound a continuous one; returns what it did."""
    t0 = time.time()
    try:
        if continuous:
            # returns once a trigger finds no new input: at most one interval after the data
            q.processAllAvailable()
            q.stop()
        else:
            q.awaitTermination(timeout_s)
            if q.isActive:
                q.stop()
                raise TimeoutError(f"stream {q.name} did not finish in {timeout_s}s")
    finally:
        exc = q.exception()
    if exc is not None:
        raise exc
    seen, run = _progress(spark), str(q.runId)
    if not seen.ended[run].wait(60):  # reports come in order: after the last one, all are in
        raise TimeoutError(f"the progress of stream {q.name} did not arrive")
    seen.ended.pop(run)
    res = seen.runs.pop(run, RunResult())
    res.duration_ms = int((time.time() - t0) * 1000)
    return res
