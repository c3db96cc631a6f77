"""Near-duplicate groups at a word-shingle similarity, with SimHash as the filter.

At a Jaccard similarity of 0.8 over five-word shingles, SimHash fingerprints of copies
differ in about 9 bits and up to 18, so an index on equal segments of them would have
keys of three bits. Candidates come instead from min-hashes of the same shingles, BANDS
bands of four. A candidate must then pass the pigeonring filter over the fingerprints at
FILTER_BITS, and last the exact similarity of the shingle sets.

A bucket of up to PAIRS texts gives all its pairs. In a larger one each text is compared
with a centre that a hash picks, with the one that shares eight min-hashes with most other
texts (an original among its edited copies), with one of those that share six min-hashes
with it, and with CENTRES of those that share eight, in each band. So comparisons grow with
the rows, not with their square.

That is a first pass, which merges most of what belongs together. A second one is exact:
texts of two groups so far are compared if their shingle sets can be similar by the prefix
filter, which loses no pair. Groups are what the links of both passes connect.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import hit_slots, may_hit, probes
from .components import components
from .shared import attach, lower_ascii, materialized, scoped, sliced
from .simhash import Pigeonring, hashes, simhash

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
DEPTHS = (4, 6, 8)
PAIRS = 16
#: Centres of a bucket of texts that share the most min-hashes.
CENTRES = 4
#: Bits that fingerprints of texts as similar as SIMILARITY may differ in.
FILTER_BITS = 22
#: Second pass: the commonest shingles, which prefixes take last, and the share of texts they are counted in.
COMMON = 1 << 16
SAMPLE = 16
SAMPLE_LEAST = 1 << 13
#: Texts of a tile, the unit in which the texts of a shingle are compared.
TILE = 64

_SEEDS = np.random.default_rng(42).integers(1, 1 << 63, (BANDS * DEPTHS[-1], 2), dtype=np.uint64) | np.uint64(1)


def _band_keys(h: np.ndarray) -> np.ndarray:
    """For each band and depth, a hash of that many min-hashes."""
    low = np.full(len(_SEEDS), np.iinfo(np.uint64).max)
    for at in range(0, len(h), 256):
        low = np.minimum(low, ((h[at : at + 256, None] * _SEEDS[:, 0] + _SEEDS[:, 1]) >> np.uint64(11)).min(axis=0))
    low = low.reshape(BANDS, -1)
    key, out = np.zeros(BANDS, np.uint64), []
    for depth in range(1, DEPTHS[-1] + 1):
        key = (key ^ low[:, depth - 1]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        if depth in DEPTHS:
            out.append(key.copy())
    return np.stack(out, axis=1).view(np.int64)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """_row, doc_id, text_hash, fp, keys (BANDS x DEPTHS), shingles (sorted 32-bit hashes)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches):
        for batch in sliced(batches):
            fps, keys, sets = [], [], []
            for text in batch.column("text").to_pylist():
                h = np.unique(hashes(text, shingle))
                fps.append(simhash(h))
                keys.append(_band_keys(h).ravel() if len(h) else None)
                sets.append(np.unique((h >> np.uint64(32)).astype(np.uint32)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("_row", "doc_id", "text_hash")] + [pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
                ["_row", "doc_id", "text_hash", "fp", "keys", "shingles"],
            )

    return docs.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", text_hash().alias("text_hash"), lower_ascii(F.coalesce("text", F.lit(""))).alias("text")
    ).mapInArrow(sketch, f"_row long, doc_id {kind}, text_hash long, fp long, keys array<long>, shingles binary")


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def candidates(sketched: DataFrame, total: int) -> DataFrame:
    """Distinct pairs (a, b) of rows that share a bucket, with a > b, as said above."""
    n = len(DEPTHS)
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(
        i.alias("band"), *[F.get("keys", i * n + d).alias(f"k{d}") for d in range(n)]
    )))
    keyed = sketched.filter("keys is not null").select("_row", "fp", band.alias("e"))
    # a key of its own for each band and depth, so that one group-by serves all
    keyed = keyed.select("_row", "fp", *[F.xxhash64("e.band", F.lit(d), f"e.k{d}").alias(f"k{d}") for d in range(n)])
    # most keys are of one text only; a filter finds that before anything shuffles
    bits = hit_slots(keyed.select(*probes("k0")), total * BANDS, times=2)
    keyed = materialized(keyed.filter(may_hit(sketched.sparkSession, bits)(*probes("k0"))))

    def buckets_of(rows: DataFrame, d: int, centres: int) -> DataFrame:
        picked = [F.min(F.struct(F.xxhash64("_row", f"k{d}", F.lit(i)).alias("h"), "_row", "fp")) for i in range(centres)]
        return rows.groupBy(f"k{d}").agg(F.count("*").alias("n"), F.array(*picked).alias("centres")).filter("n > 1")

    def star(rows: DataFrame) -> DataFrame:
        near = rows.select("_row", "fp", F.explode("centres").alias("c")).filter(F.col("_row") != F.col("c._row"))
        return near.select(F.greatest("_row", "c._row").alias("a"), F.col("fp").alias("fa"), F.least("_row", "c._row").alias("b"), F.col("c.fp").alias("fb"))

    buckets = materialized(buckets_of(keyed, 0, 1))
    members = materialized(attach(keyed, buckets, "k0", "n", total * BANDS))
    small = members.filter(F.col("n") <= PAIRS).select("k0", "_row", "fp")
    large = members.filter(F.col("n") > PAIRS)
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.k0") == F.col("y.k0")) & (F.col("x._row") > F.col("y._row"))).select(
        F.col("x._row").alias("a"), F.col("x.fp").alias("fa"), F.col("y._row").alias("b"), F.col("y.fp").alias("fb")
    )
    pairs = pairs.unionByName(star(large))
    # what all copies of a text share is the text's, so it has its deepest keys with most others
    deepest = f"k{n - 1}"
    held = attach(large.select("_row", deepest), large.groupBy(deepest).agg(F.count("*").alias("_n")), deepest, "_n", total * BANDS)
    central = materialized(large.select("k0", "_row", "fp").join(held.groupBy("_row").agg(F.sum("_n").alias("shares")), "_row"))
    best = central.groupBy("k0").agg(F.array(F.max(F.struct("shares", "_row", "fp"))).alias("centres"), F.count("*").alias("n"))
    pairs = pairs.unionByName(star(attach(central, best, "k0", "n", total * BANDS)))
    for d in range(1, n):
        deeper = large.select("_row", "fp", f"k{d}")
        pairs = pairs.unionByName(star(attach(deeper, buckets_of(deeper, d, CENTRES if d == n - 1 else 1), f"k{d}", "n", total * BANDS)))
    ring = Pigeonring(FILTER_BITS, 8)
    return pairs.filter(ring.near(F.col("fa"), F.col("fb"))).select("a", "b").distinct()


def near_links(sketched: DataFrame, total: int, similarity: float) -> DataFrame:
    """The candidates (a, b) whose shingle sets have at least that Jaccard similarity."""
    return verified(sketched, materialized(candidates(sketched, total)), total, similarity)


def verified(sketched: DataFrame, pairs: DataFrame, total: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets have at least that Jaccard similarity."""
    # only the sets of texts that are in some pair shuffle, and a few more
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_row"))
    in_pair = may_hit(sketched.sparkSession, hit_slots(ends.select(*probes("_row")), min(total, 2 * pairs.count()), times=1))
    sets = sketched.filter(in_pair(*probes("_row"))).select("_row", "shingles")

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= similarity * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    # few rows may be in most pairs: both sides are exchanged, so skewed keys are split at run time
    first = pairs.join(sets.select(F.col("_row").alias("a"), F.col("shingles").alias("sa")), "a")
    return first.join(sets.select(F.col("_row").alias("b"), F.col("shingles").alias("sb")), "b").filter(similar("sa", "sb")).select("a", "b")


def _common(sketched: DataFrame, total: int) -> np.ndarray:
    """Up to COMMON shingles that many texts of a sample have, the rarest first.

    They only order the shingles: any order finds the same links.
    """

    def shingles(batches):
        for batch in sliced(batches):
            sets = [np.frombuffer(x, np.uint32) for x in batch.column("shingles").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*sets, np.empty(0, np.uint32)]).astype(np.int64))], ["token"])

    some = sketched.filter(F.pmod(F.xxhash64("_row"), F.lit(SAMPLE)) == 0) if total > SAMPLE * SAMPLE_LEAST else sketched.filter(
        F.pmod(F.xxhash64("_row"), F.lit(max(1, total))) < SAMPLE_LEAST
    )
    counted = some.select("shingles").mapInArrow(shingles, "token long").groupBy("token").agg(F.count("*").alias("n")).filter("n > 2")
    top = counted.orderBy(F.desc("n"), "token").limit(COMMON).collect()
    return np.array([r["token"] for r in reversed(top)], np.int64)


def prefixes(sketched: DataFrame, common: np.ndarray, similarity: float) -> DataFrame:
    """_row, size, tokens of each set: the shingles one of which it shares, as one of theirs,
    with each set at `similarity`. A shingle's place in tokens is its place in the order of all.
    """
    shared = sketched.sparkSession.sparkContext.broadcast((np.sort(common), np.argsort(common)))

    def prefix(batches):
        known, rank = shared.value
        for batch in sliced(batches):
            sizes, tokens = [], []
            for blob in batch.column("shingles").to_pylist():
                s = np.frombuffer(blob, np.uint32).astype(np.int64)
                # sets of n that share fewer than similarity * n with this one are not similar to it
                length = len(s) - math.ceil(similarity * len(s) - 1e-6) + 1 if len(s) else 0
                if len(known):
                    i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    held = known[i] == s
                    s = np.concatenate([s[~held], s[held][np.argsort(rank[i[held]])]])
                sizes.append(len(s))
                tokens.append(s[:length].astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(sizes, pa.int32()), pa.array(tokens, pa.list_(pa.int32()))], ["_row", "size", "tokens"])

    return sketched.select("_row", "shingles").mapInArrow(prefix, "_row long, size int, tokens array<int>")


def missed(sketched: DataFrame, labels: DataFrame, total: int, similarity: float) -> DataFrame:
    """Distinct pairs (a, b), a > b, of two labels that may be similar; all that are similar among them.

    labels has node and label; what it lacks is a group of its own. Per shingle, the texts
    of all groups but the largest are compared with all its texts, tile by tile. Only a
    shingle's count and its least and greatest group shuffle for every text, summed before
    they do; rows of texts do so only for shingles that two groups have.
    """
    spark = sketched.sparkSession
    sized = materialized(attach(labels, labels.groupBy("label").agg(F.count("*").alias("n_group")), "label", "n_group", total))
    texts = materialized(
        prefixes(sketched, _common(sketched, total), similarity).join(sized, F.col("_row") == F.col("node"), "left").select(
            "_row", "size", "tokens", F.coalesce("label", "_row").alias("label"), F.coalesce("n_group", F.lit(1)).alias("n_group")
        )
    )
    shared = materialized(
        texts.select("label", F.explode("tokens").alias("token")).groupBy("token")
        .agg(F.count("*").alias("n"), F.min("label").alias("_l"), F.max("label").alias("_m")).filter("_l < _m").select("token", "n")
    )
    n_shared, n_rows = shared.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    in_two = may_hit(spark, hit_slots(shared.select(*probes("token")), n_shared, times=1))
    each = texts.select("_row", "size", "label", "n_group", F.posexplode("tokens").alias("at", "token")).filter(in_two(*probes("token")))
    member = materialized(attach(each, shared, "token", "n", n_rows))
    major = member.groupBy("token").agg(F.max(F.struct("n_group", "label"))["label"].alias("major"), F.count("*").alias("_n"))
    member = materialized(attach(member.drop("n_group"), major, "token", "_n", n_rows))
    tiles = F.ceil(F.col("n") / TILE).cast("long")
    x = member.withColumn("tile", F.pmod(F.xxhash64("_row"), tiles)).alias("x")
    y = member.filter("label != major").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))).alias("y")
    c = lambda name: (F.col(f"x.{name}"), F.col(f"y.{name}"))
    (xr, yr), (xs, ys), (xa, ya), (xl, yl) = c("_row"), c("size"), c("at"), c("label")
    # at the first shingle they share, what is left of both must suffice; another one needn't tell
    enough = F.least(xs - xa, ys - ya) >= similarity / (1 + similarity) * (xs + ys) - 1e-6
    long = F.least(xs, ys) >= similarity * F.greatest(xs, ys) - 1e-6
    met = (F.col("x.token") == F.col("y.token")) & (F.col("x.tile") == F.col("y.tile"))
    return (
        x.join(y, met & (xl != yl) & ((xl == F.col("x.major")) | (xr < yr)) & long & enough)
        .select(F.greatest(xr, yr).alias("a"), F.least(xr, yr).alias("b"))
        .distinct()
    )


def all_labels(sketched: DataFrame, total: int, similarity: float) -> DataFrame:
    """node and label of what is connected by all links of at least that similarity.

    What each step writes goes when its result is there.
    """
    spark = sketched.sparkSession
    links = scoped(spark, lambda: near_links(sketched, total, similarity))
    labels = scoped(spark, lambda: components(links))
    more = scoped(spark, lambda: verified(sketched, scoped(spark, lambda: missed(sketched, labels, total, similarity)), total, similarity))
    if more.isEmpty():
        return labels
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))


def dropped_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and text_hash of the rows that go: all of each group but its smallest doc_id.

    Null text is empty. Texts without words are near none. A null doc_id counts as smallest.
    """
    sketched = materialized(sketches(docs, shingle))
    total = sketched.count()
    labels = all_labels(sketched, total, similarity)
    known = sketched.select(F.col("_row").alias("node"), "doc_id", "text_hash")
    grouped = materialized(labels.join(known, "node"))
    stays = grouped.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("stays"), F.count("*").alias("n"))
    return (
        attach(grouped, stays, "label", "n", total)
        .filter(~F.struct("doc_id", "text_hash").eqNullSafe(F.col("stays")))
        .select("doc_id", "text_hash")
        .distinct()
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each near-duplicate group, in all their columns.

    Rows with one doc_id and one text stay or go together. Columns may have any names.
    """
    gone = scoped(docs.sparkSession, lambda: dropped_copies(docs, shingle, similarity)).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    return (
        docs.select(F.struct("*").alias("_doc"), "doc_id", text_hash().alias("text_hash"))
        .join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_anti")
        .select("_doc.*")
    )
