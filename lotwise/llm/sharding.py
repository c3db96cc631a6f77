"""Contiguous shards of near equal bytes, from prefix sums over partition totals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed, partitions, table


def contiguous_shards(rows: DataFrame, id_col: str, size_col: str, n_shards: int) -> DataFrame:
    """Give every row a shard (0 to n_shards - 1) and a slot in it.

    Rows are range-partitioned and sorted by (id, size, crc); each partition is summed
    where it lies, only one total per partition goes to the driver, and a second pass
    adds the offsets. A row belongs to the shard in which the middle of its bytes falls,
    so shards are contiguous in id order and differ by at most one row's size.

    `rows` needs id_col, size_col (long, at least 1) and text_crc32. Null ids come first;
    repeated ids and rows keep one slot each; an empty table gives an empty result.
    The sorted rows hold numbers only: texts are not shuffled.
    """
    order = [F.col(id_col), F.col(size_col), F.col("text_crc32")]
    ranged = checkpointed(
        rows.repartitionByRange(partitions(rows), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    # one row per partition
    totals = {
        r["_part"]: (r["bytes"], r["n"])
        for r in ranged.groupBy("_part").agg(F.sum(size_col).alias("bytes"), F.count("*").alias("n")).collect()
    }
    before, bytes_so_far, rows_so_far = {}, 0, 0
    for part in sorted(totals):
        before[part] = (bytes_so_far, rows_so_far)
        bytes_so_far += totals[part][0]
        rows_so_far += totals[part][1]
    total = max(1, bytes_so_far)

    def place(batches):
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if at is None:
                at = before[batch.column("_part")[0].as_py()]
            size = batch.column(size_col).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size) + at[0]
            middle = 2 * ends - size  # twice the middle of the row's bytes
            shard = np.minimum(n_shards - 1, middle * n_shards // (2 * total))
            row = np.arange(len(size), dtype=np.int64) + at[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard, pa.int32()), pa.array(row, pa.int64())],
                names=[*batch.schema.names, "shard", "_row"],
            )
            at = (int(ends[-1]), at[1] + len(size))

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in ranged.schema)}, shard int, _row long"
    placed = ranged.mapInArrow(place, schema)
    starts = placed.groupBy("shard").agg(F.min("_row").alias("_start"))  # n_shards rows at most
    return (
        placed.join(F.broadcast(starts), "shard")
        .withColumn("slot", F.col("_row") - F.col("_start"))
        .drop("_part", "_row", "_start")
    )


def document_shards(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1; null text: 1), text_crc32 (null text: 0), shard, slot."""
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return contiguous_shards(sized, "doc_id", "size", n_shards)


def op9_prefix_sum_shards(spark, sf_dir):
    return document_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

