"""Helpers the training-data operators share: lineage cuts, skew-safe joins."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import checkpointed, delete, scratch, shuffles_dropped

__all__ = ["attach", "checkpointed", "lower_ascii", "materialized", "partitions", "scoped", "sliced", "small_batches", "split_pieces", "table"]

#: A key is hot when it has more rows than total / HOT_SHARE (and HOT_LEAST).
#: At most HOT_SHARE keys can be hot, which bounds what is broadcast.
HOT_SHARE = 2000
HOT_LEAST = 100


#: Rows that a Python worker holds as objects at a time.
SLICE = 256


def sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a worker's memory doesn't follow the session's batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024):
    """Queries that run meanwhile send wide rows to Python workers in batches of so many, not of the session's number."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Bytes of a text that are split at a time.
PIECE = 1 << 20


def split_pieces(data: bytes, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """What blanks separate once the bytes are translated, in lists that together have all of the text's."""
    data, at = data.translate(table), 0
    while at < len(data):
        end = data.find(b" ", at + piece) if at + piece < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def partitions(df: DataFrame) -> int:
    """As many as the session shuffles into, and at least as many as df is read in."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


#: Paths of tables written since each scoped() call that is under way.
_written: list[list[str]] = []


def materialized(df: DataFrame) -> DataFrame:
    """Write df to a compressed table in the shared folder and read it back.

    The table goes when the application ends, or with the scoped() call it was written in.
    """
    spark = df.sparkSession
    path = scratch(spark, "table")
    if _written:
        _written[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scoped(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """build()'s result, materialised; what is written and shuffled on the way to it is deleted."""
    with shuffles_dropped(spark):
        _written.append([])
        try:
            result = build()
        finally:
            paths = _written.pop()
        try:
            return materialized(result)
        finally:
            for path in paths:
                delete(spark, path)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with one row per key, where few keys may hold most rows.

    `size` is the column of `groups` with the number of rows of the key. Hot keys,
    at most HOT_SHARE of them by construction, are broadcast so that their rows stay
    where they are; all others shuffle.
    """
    limit = max(HOT_LEAST, total // HOT_SHARE)
    hot = groups.filter(F.col(size) > limit)
    cold = groups.filter(F.col(size) <= limit)
    marks = hot.select(key)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(marks), key, "left_anti").join(cold, key)
    )


def lower_ascii(text):
    """Lower-case A-Z only; null stays null."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
