"""Streams that are watched: what each batch did is kept, and what failed is started again."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from hazardlake import constants as K
from hazardlake.schemas import DOUBLE, LONG, STRING, TIMESTAMP, struct

#: Rows of the progress log that are held until they are written.
HELD = 10_000

PROGRESS = struct(
    query_id=STRING,
    run_id=STRING,
    name=STRING,
    event=STRING,
    batch_id=LONG,
    at=TIMESTAMP,
    input_rows=LONG,
    rows_per_second=DOUBLE,
    duration_ms=LONG,
    late_rows=LONG,
    message=STRING,
)


class ProgressLog(StreamingQueryListener):
    """One row for each start, batch and end of the queries of a session.

    Rows wait in memory, the last ``held`` of them, until ``write`` appends them to a table. Batches
    without rows are left out unless ``idle`` is set.
    """

    def __init__(self, held: int = HELD, idle: bool = False):
        self._rows = deque(maxlen=held)
        self._names = {}
        self._idle = idle
        self._lock = threading.Lock()

    def _add(self, query_id, run_id, event, at, batch_id=None, rows=None, rate=None, took=None, late=None, message=None):
        moment = datetime.fromisoformat(at.replace("Z", "+00:00")).replace(tzinfo=None)
        with self._lock:
            name = self._names.get(str(run_id))
            self._rows.append((str(query_id), str(run_id), name, event, batch_id, moment, rows, rate, took, late, message))

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name
        self._add(event.id, event.runId, "started", event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows or self._idle:
            late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            rate = float(p.processedRowsPerSecond)
            took = int(p.durationMs.get("triggerExecution", 0))
            self._add(p.id, p.runId, "progress", p.timestamp, p.batchId, p.numInputRows, rate, took, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        now = datetime.now(timezone.utc).isoformat()
        self._add(event.id, event.runId, "failed" if event.exception else "ended", now, message=event.exception)

    def wait_for(self, event: str, seconds: float = 30) -> bool:
        """Whether an event of this kind has come in by then; events arrive a little after what they tell of."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            with self._lock:
                if any(row[3] == event for row in self._rows):
                    return True
            time.sleep(0.05)
        return False

    def rows(self, spark: SparkSession) -> DataFrame:
        """What waits, as a table of ``PROGRESS``."""
        with self._lock:
            waiting = list(self._rows)
        return spark.createDataFrame(waiting, PROGRESS)

    def write(self, spark: SparkSession, path: str) -> int:
        """Append what waits to a table and forget it; the number of rows."""
        with self._lock:
            waiting = list(self._rows)
            self._rows.clear()
        if waiting:
            spark.createDataFrame(waiting, PROGRESS).coalesce(1).write.mode("append").parquet(path)
        return len(waiting)


def supervise(
    start: Callable[[], Mapping[str, StreamingQuery] | StreamingQuery],
    wait_seconds: float = K.RETRY_SECONDS,
    attempts: int | None = None,
    healthy_seconds: float = 3600,
    on_failure: Callable[[str, StreamingQueryException], None] | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run streams until they end by themselves, and start them again when one fails; the number of failures.

    ``start`` starts the queries, from their checkpoints, so nothing that was done is done again. If one of
    them fails the others are stopped, and after ``wait_seconds`` all start again.
    ``attempts`` failures in a row end it with the last one (None: never); a run of ``healthy_seconds`` counts
    as a new beginning. ``on_failure`` gets the name of the query and its exception.
    """
    failures = in_a_row = 0
    while True:
        begun = time.monotonic()
        started = start()
        queries = dict(started) if isinstance(started, Mapping) else {started.name or "query": started}
        failed = _first_failure(queries)
        if failed is None:
            return failures
        name, error = failed
        for query in queries.values():
            query.stop()
        failures += 1
        in_a_row = 1 if time.monotonic() - begun >= healthy_seconds else in_a_row + 1
        if on_failure:
            on_failure(name, error)
        if attempts is not None and in_a_row >= attempts:
            raise error
        sleep(wait_seconds)


def _first_failure(queries: Mapping[str, StreamingQuery], poll_seconds: float = 1.0):
    """Name and exception of the first query that fails; None when all have ended well."""
    running = dict(queries)
    while running:
        for name, query in list(running.items()):
            try:
                if query.awaitTermination(poll_seconds):
                    del running[name]
            except StreamingQueryException as error:
                return name, error
    return None
