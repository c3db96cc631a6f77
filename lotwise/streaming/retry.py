"""Retries as a stream: a failed request comes out again, its counter raised, when it is due."""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.predicates import is_retryable
from ..operators.health import backoff_median
from .health import use_state_store


class _Pending(StatefulProcessor):
    """A url's retries that aren't due yet, packed by batch, with one timer for the first moment that any is due at."""

    made = Row("url", "attempt", "due_us", "dont_filter")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "attempt binary, due_us binary")
        self.timer = handle.getValueState("timer", "at_ms long")

    def handleInputRows(self, key: tuple[Any], rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        attempts, dues = array("i"), array("q")
        for r in rows:
            attempt, due = r["attempt"], r["due_us"]
            if due is None:
                continue
            if due <= now:
                yield self.made(key[0], attempt + 1, due, True)
            else:
                attempts.append(attempt + 1)
                dues.append(due)
        if dues:
            self.pending.appendValue((attempts.tobytes(), dues.tobytes()))
            self._wake(math.ceil(min(dues) / 1000))

    def handleExpiredTimer(self, key: tuple[Any], timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() * 1000
        packed = [tuple(r) for r in self.pending.get()]
        if not packed:
            return
        attempts = np.concatenate([np.frombuffer(a, np.int32) for a, _ in packed])
        dues = np.concatenate([np.frombuffer(d, np.int64) for _, d in packed])
        later = dues > now
        if later.any():
            self.pending.put([(attempts[later].tobytes(), dues[later].tobytes())])
            at_ms = math.ceil(int(dues[later].min()) / 1000)
            self.timer.update((at_ms,))
            self.handle.registerTimer(at_ms)
        else:
            self.pending.clear()
            self.timer.clear()
        for attempt, due in zip(attempts[~later].tolist(), dues[~later].tolist()):
            yield self.made(key[0], attempt, due, True)

    def _wake(self, at_ms: int) -> None:
        """A timer at that moment, unless an earlier one will look; one that comes too late is left, and finds less or nothing."""
        known = self.timer.get()
        if known is None or at_ms < known[0]:
            self.timer.update((at_ms,))
            self.handle.registerTimer(at_ms)

    def close(self) -> None:
        pass


def stream_retries(log: DataFrame) -> DataFrame:
    """url, attempt, due_us, dont_filter of each request to make again, over a stream of (url string, us, status, attempt).

    A response that may be retried (predicates.is_retryable) waits for the median delay of
    its attempt after its moment us, by the wall clock, and comes out with its attempt raised
    and past the filter of what was seen. What waits survives a restart, from
    whose first batch with rows on it comes out again. Responses whose time is past come out
    with the batch they are in, and need no state. Rows without url, us or status make none.
    """
    use_state_store(log.sparkSession)
    due = F.when(is_retryable(F.col("status"), F.col("attempt")), F.col("us") + (1e6 * backoff_median(F.col("attempt"))).cast("long"))
    rows = log.filter("url is not null").select("url", F.col("attempt").cast("int").alias("attempt"), due.alias("due_us"))
    return rows.groupBy("url").transformWithState(_Pending(), "url string, attempt int, due_us long, dont_filter boolean", "Append", "ProcessingTime")


def appended(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rows to a table under the batch's id; a batch that is run again overwrites its rows."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
