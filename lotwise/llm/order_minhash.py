"""Document fingerprints by Order MinHash.

The k-mers of a text's code points are numbered by occurrence, so that the second 'the '
differs from the first, and hashed. The hash range is cut into BINS equal parts; in each,
the TUPLE smallest are selected, put back in text order, and hashed as a tuple. A tuple
changes if a selected k-mer goes, comes or moves past another one, which makes the share
of equal tuples follow edit distance rather than sets alone.

A fingerprint is BINS numbers of 32 bits in hexadecimal. A bin without k-mers is zero
(short texts); texts shorter than K have one k-mer, the whole text; an empty text has
zeros only. Likeness is the share of equal bins among those that are not zero in both;
two empty texts have likeness 1.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, sliced, table

K = 8
TUPLE = 2
BINS = 64

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD[1]
    h = (h ^ (h >> np.uint64(27))) * _ODD[2]
    return h ^ (h >> np.uint64(31))


def fingerprint(text: str, k: int = K, size: int = TUPLE, bins: int = BINS) -> np.ndarray:
    """BINS unsigned 32-bit integers; bins must be a power of two."""
    out = np.zeros(bins, np.uint32)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(c):
        return out
    h, width, target = c + np.uint64(1), 1, min(k, len(c))
    factor = int(_ODD[0])
    while width < target:  # a polynomial hash of doubling width
        step = min(width, target - width)
        if step < width:
            # the last step overlaps; both halves together still cover every code point
            h = h[:-step] * np.uint64(factor) + h[step:]
        else:
            h = h[:-width] * np.uint64(factor) + h[width:]
        width += step
        factor = (factor * factor + 2) % (1 << 64)
    h = _mix(h)

    # occurrence numbers: equal hashes in text order
    order = np.argsort(h)
    ranked = h[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1])
    key = h
    if len(same):
        tied = np.zeros(len(h), bool)
        tied[same] = tied[same + 1] = True
        first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        run = np.cumsum(first)
        at = np.flatnonzero(tied)
        # within a run, positions ascend
        packed = np.sort(run[at] * np.int64(len(h)) + order[at])
        pos, of = packed % len(h), packed // len(h)
        begin = np.concatenate([[True], of[1:] != of[:-1]])
        number = np.arange(len(of)) - np.maximum.accumulate(np.where(begin, np.arange(len(of)), 0))
        key = h.copy()
        later = number > 0
        key[pos[later]] = _mix(h[pos[later]] + number[later].astype(np.uint64) * _ODD[0])
        order = np.argsort(key)
        ranked = key[order]

    edge = np.searchsorted(ranked, np.arange(bins, dtype=np.uint64) << np.uint64(64 - bins.bit_length() + 1))
    have = np.diff(np.append(edge, len(ranked)))
    take = edge[:, None] + np.arange(size)
    good = np.arange(size) < have[:, None]
    pos = np.where(good, order[np.minimum(take, len(ranked) - 1)], len(h))
    pos.sort(axis=1)
    padded = np.append(key, np.uint64(0))
    total = np.zeros(bins, np.uint64)
    for j in range(size):
        total = _mix(total * _ODD[0] + padded[pos[:, j]] + np.uint64(j + 1))
    return np.where(have > 0, np.maximum(total >> np.uint64(32), 1), 0).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a | b) != 0
    return float((a == b)[used].mean()) if used.any() else 1.0


def hexadecimal(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with the fingerprint of every text; null counts as empty. No shuffle."""

    @F.pandas_udf("string")
    def of(text: pd.Series) -> pd.Series:
        return text.fillna("").map(lambda t: hexadecimal(fingerprint(t)))

    return docs.withColumn("fingerprint", of("text"))


#: Sampled rows a run, from which runs are cut.
SAMPLES = 64
#: Order of rows: doc_id (null first); rows of one doc_id by CRC-32 of the text (null first), then as they lie.
ORDER = ("doc_id", "_crc", "_row")
LEAST = -(1 << 63)


def _place() -> list:
    """ORDER as numbers without nulls: a pandas column with nulls would be of floats."""
    return [
        F.col("doc_id").isNotNull().cast("int").alias("known"), F.coalesce("doc_id", F.lit(LEAST)).cast("long").alias("doc"),
        F.coalesce("_crc", F.lit(-1)).cast("long").alias("crc"), F.col("_row").alias("row"),
    ]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows dealt in runs of ascending doc_id, each with the first row of the next run.

    doc_id, text, _crc, _row, _run, _tail: a run's own rows, then one with _tail set, which
    is a copy of the first row after it (of the first of all, after the last). Runs are cut
    at quantiles of a sample of ORDER, SAMPLES rows a run, so rows of one doc_id, or with
    none, may fill many runs. doc_id is an integer; docs must be read alike each time.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.crc32("text").alias("_crc"), F.monotonically_increasing_id().alias("_row"))
    share = max(1, docs.count() // (SAMPLES * parts))
    sample = sorted(map(tuple, rows.filter(F.pmod(F.xxhash64("_row"), F.lit(share)) == 0).select(*_place()).collect()))
    cuts = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    ids = np.array([doc for _, doc, _, _ in cuts], np.int64)

    @F.pandas_udf("int")
    def run_of(known: pd.Series, doc: pd.Series, crc: pd.Series, row: pd.Series) -> pd.Series:
        run, end = np.searchsorted(ids, doc.to_numpy()), np.searchsorted(ids, doc.to_numpy(), "right")
        for i in np.flatnonzero(run < end).tolist():  # cuts within this doc_id
            run[i] = bisect_right(cuts, (known[i], doc[i], crc[i], row[i]))
        return pd.Series(run).astype("int32")

    dealt = rows.select("*", run_of(*_place()).alias("_run"))
    firsts = sorted((r["_run"], r["first"]["_row"]) for r in dealt.groupBy("_run").agg(F.min(F.struct(*ORDER)).alias("first")).collect())  # `parts` rows at most
    heads = spark.createDataFrame([(firsts[i - 1][0], row) for i, (_, row) in enumerate(firsts)], "_before int, _first long")
    own = F.struct(F.col("_run").alias("r"), F.lit(False).alias("t"))
    copy = F.struct(F.col("_before").alias("r"), F.lit(True).alias("t"))
    return (
        dealt.join(F.broadcast(heads), F.col("_row") == F.col("_first"), "left")
        .withColumn("_to", F.explode(F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, copy))))
        .select("doc_id", "text", "_crc", "_row", F.col("_to.r").alias("_run"), F.col("_to.t").alias("_tail"))
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint against its edited text's and the next document's.

    The last floor(n/4) code points of a text are replaced by the first as many of the
    next document (or all it has). Texts shuffle once, to be sorted by doc_id in runs; a
    task holds a slice of them. A table of one row is followed by itself, an empty one gives
    no rows; null text is empty, null doc_ids come first, and rows of one doc_id are in the
    order of with_next().
    """
    parts = partitions(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def pair(a, b):
        doc, text, _, own = a
        cut = len(text) // 4
        edited = text[: len(text) - cut] + b[1][:cut]
        f = fingerprint(edited) if cut else own
        return doc, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), hexadecimal(own), hexadecimal(f), likeness(own, f), likeness(own, b[3])

    def whole(held):
        if held is not None:
            raise RuntimeError("a run has no row after its last: docs gave other rows when it was read again")

    def walk(batches):
        held = None
        for batch in sliced(batches):
            out, doc_type = [], batch.schema.field("doc_id").type
            for doc, text, run, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_run", "_tail"))):
                if held is not None and held[2] == run:
                    this = (doc, text or "", run, fingerprint(text or ""))
                    out.append(pair(held, this))
                    held = None if tail else this
                elif not tail:
                    whole(held)
                    held = (doc, text or "", run, fingerprint(text or ""))
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [doc_type, *types])], names)
        whole(held)

    return (
        with_next(docs, parts)
        .repartitionById(parts, "_run")
        .sortWithinPartitions("_run", "_tail", *ORDER)
        .mapInArrow(walk, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    )


def op7_order_minhash(spark, sf_dir):
    """Fingerprints of every whole text, its edited text and the next document's."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
