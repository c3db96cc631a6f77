"""Bloom filters that Spark counts block by block, for tests in the tasks that scan rows.

A filter has SLOTS_PER_ROW slots a row up to MAX_SLOTS, one bit each when broadcast, so
what is broadcast is bounded. With more rows its size stays and it lets more rows through;
whoever uses it must decide those exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns with a row's two probes, integers from 0 on.
PROBES = ("_p0", "_p1")
SLOTS_PER_ROW = 16
#: 64 MB when broadcast.
MAX_SLOTS = 1 << 29
#: Slots of a block, the unit in which counters are merged.
BLOCK = 1 << 16
#: Rows a task counts before it hands on its slots.
FLUSH_ROWS = 1 << 20


def probes(*key: str) -> list[Column]:
    """Two independent probes out of columns."""
    return [F.xxhash64(*key, F.lit(salt)).bitwiseAND(F.lit((1 << 60) - 1)).alias(p) for salt, p in enumerate(PROBES)]


def hit_slots(probed: DataFrame, n_rows: int, times: int) -> np.ndarray:
    """A packed bit for each slot, set if at least `times` (1 or 2) rows of `probed` hit it.

    Tasks hand on the low 16 bits of the slots they hit, block by block; a slot that a hot
    key hits often is handed on twice. Blocks are summed by group.
    """
    slots = min(MAX_SLOTS, max(BLOCK, 1 << math.ceil(math.log2(SLOTS_PER_ROW * max(1, n_rows)))))

    def count(batches):
        held, n = [], 0

        def flush():
            slot, hits = np.unique(np.concatenate(held), return_counts=True)
            slot = np.repeat(slot, np.minimum(hits, times))
            block, start = np.unique(slot // BLOCK, return_index=True)
            low = np.split((slot % BLOCK).astype(np.uint16), start[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array([x.tobytes() for x in low], pa.binary())], ["block", "low"]
            )

        for batch in batches:
            # a row's own probes count once, even where they fall on one slot
            a, b = (batch.column(p).to_numpy() % slots for p in PROBES)
            held += [a, b[b != a]]
            n += batch.num_rows
            if n >= FLUSH_ROWS:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        hits = np.zeros(BLOCK, np.int64)
        for low in pdf["low"]:
            hits += np.bincount(np.frombuffer(low, np.uint16), minlength=BLOCK)
        return pd.DataFrame({"block": pdf["block"][:1], "bits": [np.packbits(hits >= times).tobytes()]})

    counted = probed.select(*PROBES).mapInArrow(count, "block int, low binary")
    bits = np.zeros(slots // 8, np.uint8)
    for row in counted.groupBy("block").applyInPandas(merge, "block int, bits binary").collect():  # as bounded as the filter
        at = row["block"] * (BLOCK // 8)
        bits[at : at + BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def may_hit(spark, bits: np.ndarray):
    """A function of two probe columns: whether both slots are set."""
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(p0: pd.Series, p1: pd.Series) -> pd.Series:
        found, hit = shared.value, True
        for p in (p0, p1):
            slot = p.to_numpy() % (len(found) * 8)
            hit &= (found[slot // 8] >> (7 - slot % 8).astype(np.uint8)) & 1 == 1
        return pd.Series(hit)

    return test
