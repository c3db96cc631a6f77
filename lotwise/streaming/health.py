"""The breaker and the token bucket as keyed streaming state that loses no row.

There is no watermark: what one key is late by says nothing about another, and a row that
a watermark filters leaves no trace. Each key has its own clock instead. Its rows wait in a
list state, packed, until its newest row is `hold_us` past them (or the key was quiet for `quiet_ms`,
by a timer), and are then folded in order of time. A row that comes when later ones have
been folded is late: it isn't folded, but comes out with `late` set, so results and late
rows together account for all input, for any order of files and any size of batches.

A row without `failed` and `closes` (the breaker), or with `asks` false (the bucket), is a
tick: it moves its key's clock and counts for nothing.

Needs the RocksDB state store, which use_state_store() sets for a session. State of what was
folded goes by its time to live when nothing has come for a key; a row after that finds a
key that is new. What waits has none, and goes when it is folded.
"""

from __future__ import annotations

import math
from array import array
from collections import deque
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import health as H

#: How far a key's rows wait for older ones, and how long they wait for any.
HOLD_US = 0
QUIET_MS = 60_000
#: Milliseconds after a key's last row that its state is kept, at least.
KEPT_MS = 7_200_000


def use_state_store(spark: SparkSession) -> None:
    """Keyed state with timers and lists lives in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def start_available_now(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Starts a query over what is there now. It ends by itself, so it makes no batches for timers alone, which would go on for ever."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)


class _InOrder(StatefulProcessor):
    """Holds a key's rows back, folds them in order, and gives late ones out as they are.

    Rows are a moment and a kind (a small number, null for a tick). What a batch brings for
    a key waits as one packed element, which is read again only when a row of the key is
    ready; so a batch costs a key a fixed number of calls to its state, however much waits.
    What waits has no time to live, as it would be lost. Subclasses have `out` (names),
    `distinct`, kind(), is_late(), late() and fold().
    """

    out: list[str]

    def __init__(self, hold_us: int, quiet_ms: int, kept_ms: int):
        self.hold_us, self.quiet_ms, self.kept_ms = hold_us, quiet_ms, kept_ms
        self.made = Row(*self.out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us binary, kind binary")
        # the first and the last moment that waits, when the last row came, and the clock meanwhile
        self.held = handle.getValueState("held", "first long, last long, seen_ms long, done long")
        self.clock = handle.getValueState("clock", "us long", self.kept_ms)
        self.open(handle)

    def handleInputRows(self, key: tuple[Any], rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held, now = self.held.get(), timerValues.getCurrentProcessingTimeInMs()
        done = held[3] if held else (self.clock.get() or (None,))[0]
        us, kinds, newest = array("q"), bytearray(), held[1] if held else done
        for r in rows:
            at = r["us"]
            if at is None:
                continue
            if newest is None or at > newest:
                newest = at
            kind = self.kind(r)
            if kind is None:
                continue
            if self.is_late(at, done):
                yield self.late(key[0], at, kind)
            else:
                us.append(at)
                kinds.append(kind)
        if newest is None:
            return
        until = newest - self.hold_us
        first = min(min(us, default=newest), held[0] if held else newest)
        ahead = until if done is None else max(done, until)
        if (us or held) and first <= until:
            yield from self._folded(key[0], [(us.tobytes(), bytes(kinds))], held, until, now, ahead)
        elif us:
            self.waiting.appendValue((us.tobytes(), bytes(kinds)))
            self._hold(first, max(max(us), held[1] if held else first), now, ahead, held)
        elif held:
            self._hold(held[0], held[1], now, ahead, held)
        else:
            self.clock.update((ahead,))

    def handleExpiredTimer(self, key: tuple[Any], timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, now = self.held.get(), timerValues.getCurrentProcessingTimeInMs()
        if held and held[2] + self.quiet_ms > now:
            self.handle.registerTimer(held[2] + self.quiet_ms)
        elif held:
            yield from self._folded(key[0], [], held, held[1], now, max(held[3], held[1]))

    def _hold(self, first: int, last: int, now: int, done: int, held: tuple | None) -> None:
        """Notes what waits; one timer at a time, set anew when it ends and rows have come since."""
        self.held.update((first, last, now, done))
        if not held:
            self.handle.registerTimer(now + self.quiet_ms)

    def _folded(self, key, fresh: list[tuple], held: tuple | None, until: int, now: int, done: int) -> Iterator[Row]:
        """Folds what waits and what came by `until`, and lets the rest wait."""
        packed = [tuple(r) for r in self.waiting.get()] + fresh if held else fresh
        us = np.concatenate([np.frombuffer(u, np.int64) for u, _ in packed])
        kinds = np.concatenate([np.frombuffer(k, np.uint8) for _, k in packed])
        rest = us > until
        if rest.any():
            self.waiting.put([(us[rest].tobytes(), kinds[rest].tobytes())])
            self._hold(int(us[rest].min()), int(us[rest].max()), now, done, held)
        else:
            if held:
                self.waiting.clear()
                self.held.clear()
            self.clock.update((done,))
        us, kinds = us[~rest], kinds[~rest]
        order = np.lexsort((kinds, us))
        us, kinds = us[order], kinds[order]
        if self.distinct and len(us):
            new = np.r_[True, (us[1:] != us[:-1]) | (kinds[1:] != kinds[:-1])]
            us, kinds = us[new], kinds[new]
        yield from self.fold(key, us.tolist(), kinds.tolist())

    def close(self) -> None:
        pass


class _Breaker(_InOrder):
    """Kinds are 0 and 1 for events that went well and failed, 2 for closes, which come after the events of their moment."""

    out = ["key", "us", "rate", "open_until_us", "late", "failed", "closes"]
    distinct = True

    def __init__(self, window_us: int, min_samples: int, threshold: float, pause_us: int, *wait: int):
        super().__init__(*wait)
        self.window_us, self.min_samples, self.threshold, self.pause_us = window_us, min_samples, threshold, pause_us

    def open(self, handle: StatefulProcessorHandle) -> None:
        # the window's events, packed, and the end of the opening
        self.model = handle.getValueState("model", "us binary, failed binary, until long", self.kept_ms)

    def kind(self, r: Row) -> int | None:
        return 2 if r["closes"] else None if r["failed"] is None else int(r["failed"])

    def is_late(self, us: int, done: int | None) -> bool:
        # events of one instant count together, so one that comes after the others were counted is late
        return done is not None and us <= done

    def late(self, key, us: int, kind: int) -> Row:
        return self.made(key, us, None, None, True, None if kind == 2 else bool(kind), kind == 2)

    def fold(self, key, us: list[int], kinds: list[int]) -> Iterator[Row]:
        packed, failed, until = self.model.get() or (b"", b"", None)
        held = deque(zip(np.frombuffer(packed, np.int64).tolist(), bytes(failed)))
        fails = sum(f for _, f in held)
        for i, (at, kind) in enumerate(zip(us, kinds)):
            if kind == 2:
                until = None
                continue
            held.append((at, kind))
            fails += kind
            if i + 1 < len(us) and us[i + 1] == at and kinds[i + 1] != 2:
                continue  # events of one instant count together
            while held[0][0] <= at - self.window_us:
                fails -= held.popleft()[1]
            rate = fails / len(held)
            if len(held) >= self.min_samples and rate > self.threshold and (until is None or at >= until):
                until = at + self.pause_us
                yield self.made(key, at, rate, until, False, None, None)
        self.model.update((array("q", [u for u, _ in held]).tobytes(), bytes(f for _, f in held), until))


class _Bucket(_InOrder):
    out = ["key", "us", "wait_s", "late"]
    distinct = False

    def __init__(self, capacity: float, rate: float, idle_s: float, *wait: int):
        super().__init__(*wait)
        self.capacity, self.rate, self.idle_s = capacity, rate, idle_s

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", "tokens double, last long", self.kept_ms)

    def kind(self, r: Row) -> int | None:
        return 0 if r["asks"] else None

    def is_late(self, us: int, done: int | None) -> bool:
        return done is not None and us < done

    def late(self, key, us: int, kind: int) -> Row:
        return self.made(key, us, None, True)

    def fold(self, key, us: list[int], kinds: list[int]) -> Iterator[Row]:
        tokens, last = self.bucket.get() or (self.capacity, None)
        for at in us:
            elapsed = (at - last) / 1e6 if last is not None else 0.0
            tokens = self.capacity if elapsed > self.idle_s else min(self.capacity, tokens + elapsed * self.rate)
            last = at
            yield self.made(key, at, 0.0 if tokens >= 1 else (1 - tokens) / self.rate, False)
            tokens -= 1 if tokens >= 1 else 0
        self.bucket.update((tokens, last))


def _with(df: DataFrame, **columns) -> DataFrame:
    return df.withColumns({name: c for name, c in columns.items() if name not in df.columns})


def stream_breaker_openings(
    events: DataFrame, window_us: int = H.WINDOW_US, min_samples: int = H.MIN_SAMPLES, threshold: float = H.THRESHOLD, pause_us: int = H.PAUSE_US,
    hold_us: int = HOLD_US, quiet_ms: int = QUIET_MS,
) -> DataFrame:
    """key, us, rate, open_until_us of openings over a stream of (key string, us, failed[, closes]); and late rows.

    A row with closes set closes its key's breaker, after the events of its moment; it isn't
    counted. open_until_us is as the breaker opened. Late rows have late set, their us, failed
    and closes, and no rate; rows without us are none. Repeated events count once.
    """
    use_state_store(events.sparkSession)
    rows = _with(events, closes=F.lit(False)).select("key", "us", "failed", "closes")
    # a breaker needs one window of events and its pause, by the times of its rows
    kept = max(KEPT_MS, math.ceil((2 * window_us + pause_us) / 1000))
    return rows.groupBy("key").transformWithState(
        _Breaker(window_us, min_samples, threshold, pause_us, hold_us, quiet_ms, kept),
        "key string, us long, rate double, open_until_us long, late boolean, failed boolean, closes boolean", "Append", "ProcessingTime",
    )


def stream_token_bucket(
    requests: DataFrame, capacity: float = H.CAPACITY, rate: float = H.REFILL_PER_S, idle_s: float = H.IDLE_S, hold_us: int = HOLD_US, quiet_ms: int = QUIET_MS
) -> DataFrame:
    """key, us, wait_s over a stream of (key string, us[, asks]); late rows have late set and no wait_s.

    A bucket that nothing has come for in idle_s seconds is full again.
    """
    use_state_store(requests.sparkSession)
    rows = _with(requests, asks=F.lit(True)).select("key", "us", "asks")
    kept = max(KEPT_MS, math.ceil(idle_s * 1000))
    return rows.groupBy("key").transformWithState(
        _Bucket(capacity, rate, idle_s, hold_us, quiet_ms, kept), "key string, us long, wait_s double, late boolean", "Append", "ProcessingTime"
    )


def routed(results: str, late: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rows to one table and late rows to another, under the batch's id.

    A batch that is run again after a failure overwrites what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, rows in ((results, batch.filter("not late")), (late, batch.filter("late"))):
                rows.drop("late").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def alerted(alerts: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch over openings: one alert (key, us, message) for each, under the batch's id.

    A batch that is run again overwrites its alerts, so it adds none.
    """

    return lambda batch, batch_id: H.opening_alerts(batch.filter("not late")).write.mode("overwrite").parquet(f"{alerts}/batch={batch_id}")
