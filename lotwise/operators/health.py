"""Health models over request and response logs: error rate, breaker, token bucket, retries.

Clocks are microseconds. The breaker and the bucket are recurrences: rows are partitioned
by key, sorted by time and folded as they stream past, with a constant state per key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import is_retryable
from ..plans.lineage import checkpointed
from .chains import chain, next_point

# The defaults of the models.
WINDOW_US = 300_000_000
MIN_SAMPLES = 10
THRESHOLD = 0.3
PAUSE_US = 1_800_000_000
CAPACITY = 5.0
REFILL_PER_S = 0.5
IDLE_S = 3600.0
BACKOFF_BASE_S = 5.0
BACKOFF_MAX_S = 300.0
SIGMA = 0.4
#: A key's time is cut into spans of so many windows for the rates.
SPAN_WINDOWS = 1


def error_rates(events: DataFrame, window_us: int = WINDOW_US, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """key, us, total, fails, rate at each event over the half-open frame (us - window, us].

    events has key, us (long) and failed (boolean). Events of one key, instant and outcome
    are one. rate is null below min_samples. A key's time is cut into spans, and each span
    also gets the window before it, so a key with most of the rows is dealt over many tasks.
    A frame is what came by its end less what came by its start: both only grow along a
    span, so the work doesn't depend on how many events a window holds.
    """
    span = SPAN_WINDOWS * window_us
    at = F.col("us") - F.pmod("us", F.lit(span))
    # an event also counts for the span that begins within a window after it
    reach = F.col("us") + F.lit(window_us - 1)
    reach = reach - F.pmod(reach, F.lit(span))
    spread = (
        events.select("key", "us", "failed").filter("us is not null").distinct()
        .withColumn("_own", at)
        .withColumn("_span", F.explode(F.when(reach > at, F.array(at, reach)).otherwise(F.array(at))))
    )
    in_time = Window.partitionBy("key", "_span").orderBy("us")
    came = lambda c: F.coalesce(c.over(in_time.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0))
    gone = lambda c: F.coalesce(c.over(in_time.rangeBetween(Window.unboundedPreceding, -window_us)), F.lit(0))
    rows, fails = F.count("*"), F.sum(F.col("failed").cast("long"))
    counted = spread.withColumns({"total": came(rows) - gone(rows), "fails": came(fails) - gone(fails)})
    rate = F.when(F.col("total") >= min_samples, F.col("fails") / F.col("total"))
    return counted.filter("_own = _span").select("key", "us", "failed", "total", "fails", rate.alias("rate"))


#: Keys with more points over the threshold than this follow pointers rather than one task's fold.
FOLD_POINTS = 1_000_000
#: A key's time is cut into spans of so many pauses, within which pointers are followed by one task.
CHAIN_PAUSES = 8


def breaker_openings(
    events: DataFrame, window_us: int = WINDOW_US, min_samples: int = MIN_SAMPLES, threshold: float = THRESHOLD, pause_us: int = PAUSE_US,
    closes: DataFrame | None = None, fold_points: int = FOLD_POINTS,
) -> DataFrame:
    """key, us, rate, open_until_us of each opening.

    The breaker opens when the rate is above the threshold (not at it) and it isn't open;
    it is open while open_until is after now. closes (key, us) are moments at which someone
    closes it, after the events of that moment: open_until ends there, and what is over the
    threshold later opens it anew; counted events stay. Only events over the threshold and
    closes are looked at: a key with up to fold_points of them (it changes the way, not the
    rows) is folded by one task, others follow pointers from opening to opening.
    """
    rates = error_rates(events, window_us, min_samples)
    over = rates.filter(F.col("rate") > threshold).select("key", "us", "rate").distinct().withColumn("closes", F.lit(False))
    if closes is not None:
        over = over.unionByName(closes.select("key", "us", F.lit(None).cast("double").alias("rate"), F.lit(True).alias("closes")).filter("us is not null"))
    over = checkpointed(over)
    hot = checkpointed(over.groupBy(F.struct("key").alias("_k")).count().filter(F.col("count") > fold_points).select("_k"))
    if hot.isEmpty():
        return _folded_openings(over, pause_us)
    of_key = F.struct("key") == F.col("_k")
    return _folded_openings(over.join(hot, of_key, "left_anti"), pause_us).unionByName(_linked_openings(over.join(hot, of_key, "left_semi"), pause_us, closes is not None))


def _linked_openings(over: DataFrame, pause_us: int, closing: bool) -> DataFrame:
    """Openings along pointers: each point's is the first one past its pause, or past the first close from it on."""
    span = 4 * pause_us
    points, closed = over.filter("not closes").select("key", "us", "rate"), F.lit(None).cast("long")
    asked = points
    if closing:
        asked, closed = next_point(points.withColumn("at", F.col("us")), over.filter("closes").select("key", "us").distinct(), "_close", span), F.col("_close")
    ends = F.least(F.col("us") + F.lit(pause_us), closed)
    # a close comes after the events of its moment, the end of a pause before them
    past = F.when(closed < F.col("us") + F.lit(pause_us), closed + 1).otherwise(F.col("us") + F.lit(pause_us))
    known = checkpointed(asked.select("key", "us", "rate", ends.alias("open_until_us"), past.alias("at")))
    opened = chain(next_point(known, points, "next", span), CHAIN_PAUSES * pause_us).select(F.col("key").alias("_k"), F.col("us").alias("_us"))
    return known.join(opened, F.col("key").eqNullSafe(F.col("_k")) & (F.col("us") == F.col("_us")), "left_semi").select("key", "us", "rate", "open_until_us")


def _folded_openings(over: DataFrame, pause_us: int) -> DataFrame:
    """Openings by one fold of each key in order of time."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, until, opened = object(), None, None
        for pdf in batches:
            out = []
            for k, us, rate, shut in zip(pdf["key"], pdf["us"], pdf["rate"], pdf["closes"]):
                if k != key:
                    if opened:
                        out.append(opened)
                    key, until, opened = k, None, None
                if shut and opened and us < opened[3]:
                    opened, until = (*opened[:3], us), us
                elif not shut and (until is None or us >= until):
                    if opened:
                        out.append(opened)
                    until = us + pause_us
                    opened = (k, us, rate, until)
            yield pd.DataFrame(out, columns=["key", "us", "rate", "open_until_us"])
        if opened:
            yield pd.DataFrame([opened], columns=["key", "us", "rate", "open_until_us"])

    kind = over.schema["key"].dataType.simpleString()
    return over.repartition("key").sortWithinPartitions("key", "us", "closes").mapInPandas(fold, f"key {kind}, us long, rate double, open_until_us long")


def is_open(open_until_us: Column, now_us: Column) -> Column:
    """Whether a breaker refuses requests at that moment."""
    return F.coalesce(open_until_us > now_us, F.lit(False))


#: A key's time is cut into spans of so long for the gate.
GATE_SPAN_US = 4 * PAUSE_US


def admitted(requests: DataFrame, openings: DataFrame, span_us: int = GATE_SPAN_US) -> DataFrame:
    """Requests (key, us) that come while their breaker is not open.

    Openings and requests are merged in order of time, and the latest end of an opening so
    far is carried to each request; no range is joined. A key's time is cut into spans, and
    only one row for each span meets others of its key. An opening counts from after its
    moment on; requests without a key or a moment are admitted.
    """
    ends = openings.filter("key is not null and us is not null").select("key", "us", F.col("open_until_us").alias("_until"), F.lit(1).alias("_opening"))
    merged = requests.withColumn("_opening", F.lit(0)).unionByName(ends, allowMissingColumns=True)
    merged = merged.withColumn("_span", F.floor(F.col("us") / F.lit(span_us)).cast("long"))
    earlier = Window.partitionBy("key").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = merged.groupBy("key", "_span").agg(F.max("_until").alias("_top")).select("key", "_span", F.max("_top").over(earlier).alias("_carry"))
    so_far = Window.partitionBy("key", "_span").orderBy("us", "_opening").rowsBetween(Window.unboundedPreceding, 0)
    open_until = F.greatest(F.max("_until").over(so_far), F.col("_carry"))
    gated = merged.join(spans, ["key", "_span"], "left").withColumn("_refused", is_open(open_until, F.col("us")))
    return gated.filter((F.col("_opening") == 0) & ~F.col("_refused")).select(*requests.columns)


def opening_alerts(openings: DataFrame) -> DataFrame:
    """One alert for each opening: key, us, message."""
    return openings.select(
        "key", "us", F.concat(F.lit("breaker opened for "), F.col("key").cast("string"), F.lit(" at rate "), F.round("rate", 4).cast("string")).alias("message")
    )


#: A key's time is cut into spans of so many times what fills a bucket.
SPAN_FILLS = 64


def _full_since(requests: DataFrame, fill_us: int) -> DataFrame:
    """key, us, seq, _from of each request: its number by time, and the last request by then that found a full bucket.

    A gap of over fill_us fills a bucket, so what comes after it needs nothing from before.
    A key's time is cut into spans, and only one row for each span with requests meets
    others of its key.
    """
    known = requests.select("key", "us").filter("key is not null and us is not null")
    spanned = known.withColumn("_span", F.floor(F.col("us") / F.lit(SPAN_FILLS * fill_us)).cast("long"))
    in_span = Window.partitionBy("key", "_span").orderBy("us")
    numbered = spanned.withColumns({"_n": F.row_number().over(in_span), "_before": F.lag("us").over(in_span)})
    begins = F.when(F.col("us") - F.col("_before") > fill_us, F.col("us"))
    spans = numbered.groupBy("key", "_span").agg(
        F.count("*").alias("_rows"), F.min("us").alias("_first"), F.max("us").alias("_last"), F.max(begins).alias("_begun")
    )
    of_key = Window.partitionBy("key").orderBy("_span")
    earlier = of_key.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("_first") - F.lag("_last").over(of_key)
    spans = spans.withColumn("_opens", F.when(gap.isNull() | (gap > fill_us), F.col("_first")))
    spans = spans.withColumns({
        "_skip": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
        "_carry": F.coalesce("_opens", F.max(F.greatest("_begun", "_opens")).over(earlier)),
    })
    joined = numbered.join(spans.select("key", "_span", "_skip", "_carry"), ["key", "_span"])
    since = F.greatest(F.col("_carry"), F.max(begins).over(in_span.rangeBetween(Window.unboundedPreceding, 0)))
    return joined.select("key", "us", (F.col("_n") + F.col("_skip")).cast("long").alias("seq"), since.alias("_from"))


def token_bucket_waits(requests: DataFrame, capacity: float = CAPACITY, rate: float = REFILL_PER_S, idle_s: float = IDLE_S) -> DataFrame:
    """key, us, seq, wait_s: seconds until a token is there, at each request.

    A bucket starts full and refills by `rate` tokens a second up to `capacity`. With one
    token or more, one is taken and the wait is 0; else the wait is (1 - tokens) / rate and
    none is taken, so several who wait are each told the same. A bucket not asked for
    idle_s seconds is forgotten, that is, full. seq numbers a key's requests by time. What
    comes between two gaps that fill a bucket is folded apart from the rest of its key.
    """
    fill_us = math.ceil(min(capacity / rate * (1 + 1e-9), idle_s) * 1e6) + 1

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, tokens, last = object(), capacity, None
        for pdf in batches:
            waits = []
            for k, begun, us in zip(pdf["key"], pdf["_from"], pdf["us"]):
                if (k, begun) != part:
                    part, tokens, last = (k, begun), capacity, us
                elapsed = max(0.0, (us - last) / 1e6)
                tokens = capacity if elapsed > idle_s else min(capacity, tokens + elapsed * rate)
                last = us
                wait = 0.0 if tokens >= 1 else (1 - tokens) / rate
                tokens -= 1 if tokens >= 1 else 0
                waits.append(wait)
            yield pdf[["key", "us", "seq"]].assign(wait_s=waits)

    kind = requests.schema["key"].dataType.simpleString()
    return (
        _full_since(requests, fill_us).repartition("key", "_from").sortWithinPartitions("key", "_from", "us", "seq")
        .mapInPandas(fold, f"key {kind}, us long, seq long, wait_s double")
    )


def backoff_median(attempt: Column, base_s: float = BACKOFF_BASE_S, max_s: float = BACKOFF_MAX_S) -> Column:
    """Median delay before the next try: base doubled each time, capped."""
    return F.least(F.lit(base_s) * F.pow(F.lit(2.0), attempt), F.lit(max_s))


def _uniform(key: Column, seed: int, draw: int) -> Column:
    """A number above 0 and at most 1 out of 48 bits of a hash of the key."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(str(draw))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") + 1) / F.lit(float(1 << 48))


def normal_draw(key: Column, seed: int = 0) -> Column:
    """A standard normal number that follows the key and the seed, so that a row is delayed alike each time it is read."""
    return F.sqrt(F.lit(-2.0) * F.ln(_uniform(key, seed, 0))) * F.cos(F.lit(2 * math.pi) * _uniform(key, seed, 1))


def lognormal_delay(median: Column, key: Column, sigma: float = SIGMA, seed: int = 0) -> Column:
    """A delay whose logarithm is normal around the median's."""
    return F.exp(F.ln(median) + F.lit(sigma) * normal_draw(key, seed))


def backoff_with_jitter(attempt: Column, key: Column, seed: int = 0, sigma: float = SIGMA) -> Column:
    return lognormal_delay(backoff_median(attempt), key, sigma, seed)


def retry_log(attempts: DataFrame) -> DataFrame:
    """attempts (url, attempt, status) with will_retry and the median delay before that."""
    retry = is_retryable(F.col("status"), F.col("attempt"))
    return attempts.withColumn("will_retry", retry).withColumn("delay_s", F.when(retry, backoff_median(F.col("attempt"))))


def final_responses(attempts: DataFrame) -> DataFrame:
    """url, attempt, status of the last attempt of each url, and whether it gave up there."""
    last = attempts.groupBy("url").agg(F.max(F.struct("attempt", "status")).alias("_last"))
    return last.select("url", "_last.attempt", "_last.status", (F.col("_last.status") >= 400).alias("gave_up"))
