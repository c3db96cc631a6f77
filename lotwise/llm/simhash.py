"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits. Its ring is cut into SEGMENTS segments; if two fingerprints
differ in at most `max_bits` bits, then from some segment on every chain of l consecutive
segments, for each l, differs in at most l * max_bits / SEGMENTS bits. Chains whose
budget is below one must be equal: they are the join key, which is longer than one
segment of the plain pigeonhole; the longer chains prune candidates before the full
Hamming check, which is the chain of all segments.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import attach, lower_ascii, materialized, table

BITS = 64
#: Fingerprints of a bucket that are compared in pairs; larger buckets go another exact way.
BUCKET = 64

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CHUNK = 1 << 15


def shingles(words: list[str], size: int) -> list[str]:
    if len(words) < size:
        return [" ".join(words)] if words else []
    return [" ".join(x) for x in zip(*(words[i:] for i in range(size)))]


def hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of an already lower-cased text, repeats included."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingles(_WORD.findall(text), size)], np.uint64)


def simhash(h: np.ndarray) -> int:
    """Signed 64-bit number whose bits are those set in over half of h; 0 for none."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), _CHUNK):
        ones += np.unpackbits(h[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprinted(docs: DataFrame, shingle: int) -> DataFrame:
    """docs with fp, the fingerprint of the whole text; null text has no words."""

    @F.pandas_udf("long")
    def of(text: pd.Series) -> pd.Series:
        return text.map(lambda t: simhash(hashes(t, shingle))).astype("int64")

    return docs.withColumn("fp", of(lower_ascii(F.coalesce(F.col("text"), F.lit("")))))


class Pigeonring:
    """Masks of chains of consecutive segments, and what they may differ in."""

    def __init__(self, max_bits: int, segments: int | None = None):
        self.max_bits = max_bits
        #: The default makes the equal chains long: with 3 * max_bits + 1 segments, 3 are equal.
        self.segments = segments or 3 * max_bits + 1
        cut = [BITS * i // self.segments for i in range(self.segments + 1)]
        part = [sum(1 << b for b in range(a, z)) for a, z in zip(cut, cut[1:])]
        self.chains = []  # for each start: (mask, budget) for each length
        for start in range(self.segments):
            mask, chain = 0, []
            for length in range(1, self.segments + 1):
                mask |= part[(start + length - 1) % self.segments]
                chain.append((mask, length * max_bits // self.segments))
            self.chains.append(chain)

    def key(self, start: int) -> int:
        """Mask of the longest chain that must be equal."""
        return max(m for m, budget in self.chains[start] if not budget)

    def keys(self, fp: Column) -> Column:
        """array of (start, key), one for each start."""
        return F.array(*[
            F.struct(F.lit(s).alias("start"), fp.bitwiseAND(F.lit(_signed(self.key(s)))).alias("key")) for s in range(self.segments)
        ])

    def _within(self, start: int, differ: Column) -> Column:
        # of the chains with one budget, the longest holds the others
        tests = {budget: mask for mask, budget in self.chains[start]}
        found = F.lit(True)
        for budget, mask in tests.items():
            found = found & (F.bit_count(differ.bitwiseAND(F.lit(_signed(mask)))) <= budget)
        return found

    def near(self, a: Column, b: Column) -> Column:
        """Whether from some segment on all chains stay within budget."""
        found = F.lit(False)
        for s in range(self.segments):
            found = found | self._within(s, a.bitwiseXOR(b))
        return found

    def within(self, start: Column, a: Column, b: Column) -> Column:
        """Whether from `start` on all chains stay within budget; the last is the Hamming check."""
        case = F.lit(False)
        for s in reversed(range(self.segments)):
            case = F.when(start == s, self._within(s, a.bitwiseXOR(b))).otherwise(case)
        return case


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that join the distinct fingerprints `fp` at max_bits or fewer.

    Links have the components of all pairs within max_bits, and join no others. Buckets of
    up to BUCKET fingerprints are compared in pairs, as the pigeonring says. A fingerprint
    in a larger bucket is not compared with it, but goes the way of ball_links(), which is
    exact too and linear in the bucket.
    """
    ring = Pigeonring(max_bits)
    keyed = fps.select("fp", F.explode(ring.keys(F.col("fp"))).alias("k")).select("fp", "k.start", "k.key")
    sizes = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).filter("n > 1")
    small = sizes.filter(F.col("n") <= BUCKET).select("start", "key")
    large = materialized(sizes.filter(F.col("n") > BUCKET))
    members = materialized(keyed.join(small, ["start", "key"], "left_semi"))
    a, b = members.alias("a"), members.alias("b")
    links = a.join(b, (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") > F.col("b.fp"))).filter(
        ring.within(F.col("a.start"), F.col("a.fp"), F.col("b.fp"))
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    total = large.agg(F.sum("n")).first()[0] or 0
    if not total:
        return links
    # each fingerprint of a large bucket, and those that may be near it: all in that bucket
    crowd = attach(keyed.withColumn("sk", F.struct("start", "key")), large.select(F.struct("start", "key").alias("sk"), "n"), "sk", "n", total)
    return links.unionByName(ball_links(crowd.select("fp").distinct(), max_bits))


def ball_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) within max_bits that connect all pairs within max_bits.

    A fingerprint is written under each centre that is half of max_bits (rounded up) or
    fewer bits away. Of two within max_bits, one is half of them (rounded down) or fewer
    bits from a centre of both. All at a centre are linked to the smallest of those that
    are so near. Only centres are grouped, with partial sums, so no group of rows meets in
    one task.
    """
    at = fps.select("fp", F.col("fp").alias("centre"))
    for _ in range(max_bits - max_bits // 2):
        flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)) for i in range(BITS)])
        at = at.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("centre")))).alias("centre")).distinct()
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= max_bits // 2
    met = at.groupBy("centre").agg(F.min(F.when(near, F.col("fp"))).alias("least"), F.count("*").alias("n")).filter("n > 1 and least is not null")
    total = fps.count()
    return attach(at, met, "centre", "n", total).select(F.col("fp").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def near_components(rows: DataFrame, max_bits: int) -> DataFrame:
    """rows (doc_id, fp, ...) with component_id, the smallest doc_id reachable.

    Rows with one fingerprint are one node, whatever their number; null doc_ids belong to
    their component but never name it, unless all are null. No rows give no rows.
    """
    nodes = materialized(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    labels = materialized(components(near_links(nodes.select("fp"), max_bits)))
    linked = nodes.join(labels, F.col("fp") == F.col("node"))
    names = linked.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("size"))
    total = labels.count()
    named = attach(linked.select("fp", "n", "label"), names, "label", "size", total).select("fp", "n", "component_id")
    alone = nodes.join(labels, F.col("fp") == F.col("node"), "left_anti").select("fp", "n", F.col("least").alias("component_id"))
    groups = materialized(named.unionByName(alone))
    return attach(rows, groups, "fp", "n", rows.count()).drop("n")


def op8_pigeonring_simhash(spark, sf_dir):
    """Fingerprints of every whole text's 3-word shingles, and their components at 2 bits; null text has no words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = materialized(fingerprinted(docs, 3).select("doc_id", "fp"))
    return near_components(rows, 2).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
