"""Chains through one key's points by successor pointers, for keys too hot for one task.

Every step is a join, or a window or fold over a bounded span of time, so a key may hold any
share of the rows, and a lost executor costs one round's partitions.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import checkpointed


def next_point(asked: DataFrame, points: DataFrame, name: str, span_us: int) -> DataFrame:
    """asked (key, at, ...) with `name`: the first us of points (key, us) of its key at or after `at`, null if none.

    Both are merged in order of time, latest first, and the last point so far is carried;
    no range is joined. A key's time is cut into spans, and only one row for each span meets
    others of its key. A null key is a key as any other; rows with a null `at` get null.
    """
    merged = asked.withColumn("_point", F.lit(None).cast("long")).unionByName(
        points.select("key", F.col("us").alias("at"), F.col("us").alias("_point")), allowMissingColumns=True
    )
    merged = merged.withColumn("_span", F.floor(F.col("at") / F.lit(span_us)).cast("long"))
    later = Window.partitionBy("key").orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = merged.groupBy("key", "_span").agg(F.min("_point").alias("_first"))
    spans = firsts.select(F.col("key").alias("_k"), F.col("_span").alias("_s"), F.min("_first").over(later).alias("_carry"))
    # a point at the moment asked for counts, so points come before those who ask
    so_far = Window.partitionBy("key", "_span").orderBy(F.desc("at"), F.col("_point").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    joined = merged.withColumn("_own", F.min("_point").over(so_far)).join(spans, F.col("key").eqNullSafe(F.col("_k")) & (F.col("_span") == F.col("_s")), "left")
    return joined.filter("_point is null").select(*asked.columns, F.when(F.col("at").isNotNull(), F.coalesce("_own", "_carry")).alias(name))


def chain(pointers: DataFrame, span_us: int) -> DataFrame:
    """key, us of the points that each key's first point leads to along pointers (key, us, next), itself included.

    next is the us of a later point of the key, or null at an end, and pointers of a key
    don't cross: a later point's is not before an earlier one's. A key's time is cut into
    spans. Where each point leaves its span is found by one pass back in time; only those
    that a pointer enters a span at are followed from span to span, by pointers that are
    doubled: after round k the first 2^k spans of each chain are known, so rounds grow with
    the logarithm of the spans. A second pass follows the chain within each span from where
    it enters. So all points are read a fixed number of times, however long the chain.
    """
    cut = lambda c: F.col(c) - F.pmod(c, F.lit(span_us))
    nodes = checkpointed(pointers.select("key", "us", "next", cut("us").alias("span"), cut("next").alias("next_span")))
    key = nodes.schema["key"].dataType.simpleString()
    of_span = ["key", "span"]
    left = nodes.repartition(*of_span).sortWithinPartitions(*of_span, F.desc("us")).mapInArrow(_exits, f"key {key}, us long, next long, enters boolean")
    left = checkpointed(left.select(F.struct("key").alias("k"), "us", "next", "enters"))
    first = left.groupBy("k").agg(F.min("us").alias("us"))
    entries = left.filter("enters").select("k", F.col("next").alias("us")).unionByName(first).distinct()
    leads = checkpointed(left.filter("next is not null").select("k", "us", "next").join(entries, ["k", "us"], "left_semi"))
    known = checkpointed(first)
    while not leads.isEmpty():
        known = checkpointed(known.unionByName(known.join(leads, ["k", "us"]).select("k", F.col("next").alias("us"))))
        on = leads.select("k", F.col("us").alias("next"), F.col("next").alias("_far"))
        leads = checkpointed(leads.join(on, ["k", "next"]).select("k", "us", F.col("_far").alias("next")))
    begins = known.select(F.col("k").alias("_k"), cut("us").alias("_span"), F.col("us").alias("begin"))
    followed = nodes.join(begins, (F.struct("key") == F.col("_k")) & (F.col("span") == F.col("_span"))).select("key", "span", "us", "next", "begin")
    return followed.repartition(*of_span).sortWithinPartitions(*of_span, "us").mapInArrow(_followed, f"key {key}, us long")


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points of spans, latest first, with next where the chain from them first is in another span; enters: by their own pointer."""
    group, later = object(), deque()  # points that a pointer may yet lead to, latest first
    for batch in batches:
        far, enters = [], []
        for k, span, us, to, to_span in zip(*(batch.column(c).to_pylist() for c in ("key", "span", "us", "next", "next_span"))):
            if (k, span) != group:
                group = (k, span)
                later.clear()
            own = to is not None and to_span != span
            if to is not None and not own:
                while later and later[0][0] > to:
                    later.popleft()
                if not later or later[0][0] != to:
                    raise ValueError(f"the pointer from {us} to {to} leads to no point or crosses another")
                to = later[0][1]
            later.append((us, to))
            far.append(to)
            enters.append(own)
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("us"), pa.array(far, pa.int64()), pa.array(enters, pa.bool_())], ["key", "us", "next", "enters"])


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of points of spans by time, those that the one at `begin` leads to, itself included."""
    group, at = object(), None
    for batch in batches:
        on = []
        for k, span, us, to, begin in zip(*(batch.column(c).to_pylist() for c in ("key", "span", "us", "next", "begin"))):
            if (k, span) != group:
                group, at = (k, span), begin
            on.append(us == at)
            if us == at:
                at = to
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("us")], ["key", "us"]).filter(pa.array(on, pa.bool_()))
