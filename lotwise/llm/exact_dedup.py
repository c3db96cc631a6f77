"""Exact dedup by two-pass Bloom filtering.

Pass 1 counts, in a Bloom filter with saturating counters, the hashes of all texts and
keeps the slots that were hit at least twice. Pass 2 tests every row: if one of its
slots was hit only once, no other row has its hash and the row passes straight through;
only the rest, the possibly repeated rows, shuffle on the hash and are decided exactly.

The filter's size is bounded (bloom.MAX_SLOTS); with more rows than that serves, more
unique rows are found possibly repeated, which costs shuffle and never changes a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import PROBES, hit_slots, may_hit
from .shared import attach, lower_ascii, materialized, table


def text_key():
    """SHA-256 (lowercase hex) of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(lower_ascii(F.coalesce(F.col("text"), F.lit(""))), 256)


def _probes():
    """Two independent 60-bit integers out of the digest."""
    return [F.conv(F.substring("text_sha256", at, 15), 16, 10).cast("long").alias(p) for at, p in zip((1, 17), PROBES)]


def dedup_decisions(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """For every row: doc_id, keep_id, group_size, kept, text_sha256; and the filter.

    Of equal texts the row with the largest doc_id stays; of repeated rows with that
    doc_id, one. A null doc_id counts as smallest. An empty table gives an empty result.
    Only doc_id and the digest are kept of a row: texts neither shuffle nor spill.
    """
    keyed = materialized(docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", text_key().alias("text_sha256")))
    n_rows = keyed.count()
    bits = hit_slots(keyed.select(*_probes()), n_rows, times=2)
    tested = keyed.withColumn("_maybe", may_hit(docs.sparkSession, bits)(*_probes()))
    straight = tested.filter(~F.col("_maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    maybe = tested.filter("_maybe").drop("_maybe")
    groups = materialized(
        maybe.groupBy("text_sha256")
        .agg(F.max(F.struct("doc_id", "_row")).alias("_keep"), F.count("*").alias("group_size"))
    )
    decided = attach(maybe, groups, "text_sha256", "group_size", n_rows).select(
        "doc_id", F.col("_keep.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"), "text_sha256",
    )
    return straight.unionByName(decided), bits


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """docs without exact copies; all columns, of any names, of the rows that stay.

    Rows that the filter finds unique pass straight through with their texts. Of the
    others only those that stay are looked up, by doc_id and digest, and repeated rows
    among them become one.
    """
    decisions, bits = dedup_decisions(docs)
    keyed = docs.select(F.struct("*").alias("_doc"), "doc_id", text_key().alias("text_sha256"))
    keyed = keyed.withColumn("_maybe", may_hit(docs.sparkSession, bits)(*_probes()))
    straight = keyed.filter(~F.col("_maybe")).select("_doc.*")
    stays = decisions.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    found = keyed.filter("_maybe").join(
        stays, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha")), "left_semi"
    )
    return straight.unionByName(found.dropDuplicates(["doc_id", "text_sha256"]).select("_doc.*"))


def op6_bloom_exact_dedup(spark, sf_dir):
    return dedup_decisions(table(spark, sf_dir, "documents"))[0]


SQL = {
    "op6_bloom_exact_dedup": """
WITH keyed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM keyed"""
}
