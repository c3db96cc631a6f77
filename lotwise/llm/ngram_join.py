"""Jaccard join over word n-grams by vertical partitioning.

All n-grams have one global order, rare ones first, as a sketch of their document counts
says; the order is cut into FRAGMENTS fragments of near equal mass, so each set has a
segment in each. Two sets that are similar enough share one of the first n-grams of both
(their prefixes), so sets meet there. For those that meet, the overlaps of their segments
are counted fragment by fragment, apart from each other, and summed for each pair.

What the order is changes no result, only how many sets meet, so the sketch has a bounded
size. An n-gram whose slot one document only has hit is in no other: it counts in a set's
size and prefix, but is no key, and a set with too many of them has no partner at all.

Equal sets are one node. Sets that meet at an n-gram that many have are first compared with a
few of them, those with the fewest n-grams of their own, as an original has among its edited
copies; what that connects needn't meet again. Rounds with other ones follow as long as they
find links. A last round then compares all that meet and aren't connected, so no link between
two components is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import hit_slots, may_hit, probes
from .components import components
from .shared import attach, materialized, scoped, sliced, small_batches, split_pieces, table

WORDS = 3
#: Two sets link when PERCENT of their union, or more, is common.
PERCENT = 90
FRAGMENTS = 8
#: Sets at an n-gram that are compared in pairs in the first round.
PAIRS = 8
#: Sets that the others at an n-gram are compared with in each of the rounds before the last, and those rounds at most.
CENTRES = 4
ROUNDS = 6
#: Sets of a tile, the unit in which the last round compares those at an n-gram.
TILE = 512
#: Slots of the sketch at most; it has four bits each (64 MB) when broadcast.
MAX_SLOTS = 1 << 27
BLOCK = 1 << 16
#: N-grams a task counts before it hands them on, and tasks whose counts of a block are summed first.
HELD = 1 << 20
TASKS = 128
#: Word hashes a task remembers.
REMEMBERED = 1 << 17

# A-Z become a-z, and all that separates words becomes a blank
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def need(size):
    """N-grams that a set of this size shares, at least, with any that it links to."""
    return -(-PERCENT * size // 100)


class Grams:
    """The sorted distinct 64-bit hashes of a text's n-grams; word hashes are remembered between texts."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, 42)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: bytes) -> np.ndarray:
        h = np.concatenate([np.empty(0, np.uint64), *(self._hashes(words) for words in split_pieces(text, _WORD_BYTES))])
        n = min(WORDS, len(h))
        if not n:
            return h
        # a text of fewer words is one n-gram, told apart by its length
        mixed = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ h[i : len(h) - n + 1 + i]) * _MIX[0]
            mixed ^= mixed >> np.uint64(29)
            mixed = mixed * _MIX[1] + _MIX[2]
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed * _MIX[3])


def gram_sets(docs: DataFrame) -> DataFrame:
    """_row, doc_id, size, set_a, set_b (a 128-bit hash of the set), grams (sorted 64-bit hashes); null text has none."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def build(batches):
        grams = Grams()
        for batch in sliced(batches):
            sizes, a, b, blobs = [], [], [], []
            for text in batch.column("text"):
                g = grams.of(text.as_py())
                blob = g.tobytes()
                digest = np.frombuffer(xxhash.xxh3_128_digest(blob), np.int64)
                sizes.append(len(g))
                a.append(digest[0])
                b.append(digest[1])
                blobs.append(blob)
            columns = [pa.array(sizes, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), *columns], ["_row", "doc_id", "size", "set_a", "set_b", "grams"])

    read = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return read.mapInArrow(build, f"_row long, doc_id {kind}, size long, set_a long, set_b long, grams binary")


def _level(counts: np.ndarray) -> np.ndarray:
    """0 to 3 as they are, then one more for each doubling, up to 15."""
    log = np.log2(np.maximum(counts, 1)).astype(np.int64)
    return np.minimum(np.where(counts < 4, counts, log + 2), 15).astype(np.uint8)


class Order:
    """The global order: by the level of an n-gram's slot, then by its hash. Cut into fragments of near equal mass."""

    def __init__(self, packed: np.ndarray, mass: np.ndarray):
        self.packed, self.shift = packed, np.uint64(64 - (2 * len(packed) - 1).bit_length())
        self.mass, self.before = mass / max(1.0, mass.sum()), (np.cumsum(mass) - mass) / max(1.0, mass.sum())

    def levels(self, grams: np.ndarray) -> np.ndarray:
        slot = (grams >> self.shift).astype(np.int64)
        return (self.packed[slot >> 1] >> ((slot & 1) << 2).astype(np.uint8)) & np.uint8(15)

    def fragments(self, grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
        at = self.before[levels] + self.mass[levels] * (grams.astype(np.float64) / 2.0**64)
        return np.minimum((at * FRAGMENTS).astype(np.int64), FRAGMENTS - 1)


def global_order(sets: DataFrame, n_grams: int) -> Order:
    """Counts, slot by slot, the sets that have an n-gram there; blocks of slots are summed in groups."""
    slots = min(MAX_SLOTS, max(BLOCK, 1 << (2 * max(1, n_grams) - 1).bit_length()))
    shift = np.uint64(64 - (slots - 1).bit_length())

    def count(batches):
        group, held, n = TaskContext.get().partitionId() // TASKS, [], 0

        def flush():
            slot, hits = np.unique(np.concatenate(held), return_counts=True)
            block, start = np.unique(slot // BLOCK, return_index=True)
            low = np.split((slot % BLOCK).astype(np.uint16), start[1:])
            hits = np.split(np.minimum(hits, 65535).astype(np.uint16), start[1:])
            columns = [pa.array([group] * len(block), pa.int32()), pa.array(block, pa.int32()), *[pa.array([x.tobytes() for x in c], pa.binary()) for c in (low, hits)]]
            return pa.RecordBatch.from_arrays(columns, ["tasks", "block", "low", "hits"])

        for batch in batches:
            for blob in batch.column("grams"):
                g = np.frombuffer(blob.as_buffer(), np.uint64)
                held.append((g >> shift).astype(np.int64))
                n += len(g)
                if n >= HELD:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    def summed(low, hits) -> np.ndarray:
        total = np.zeros(BLOCK, np.int64)
        for at, n in zip(low, hits):
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint16)
        return total

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = summed(pdf["low"], pdf["hits"])
        at = np.flatnonzero(total)
        return pd.DataFrame({"block": pdf["block"][:1], "low": [at.astype(np.uint16).tobytes()], "hits": [np.minimum(total[at], 65535).astype(np.uint16).tobytes()]})

    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        total = summed(pdf["low"], pdf["hits"])
        levels = _level(total)
        mass = np.bincount(levels, total, 16)
        return pd.DataFrame({"block": pdf["block"][:1], "packed": [(levels[::2] | (levels[1::2] << 4)).tobytes()], "mass": [mass.tolist()]})

    counted = sets.select("grams").mapInArrow(count, "tasks int, block int, low binary, hits binary")
    if sets.rdd.getNumPartitions() > TASKS:
        counted = counted.groupBy("tasks", "block").applyInPandas(add, "block int, low binary, hits binary")
    packed, mass = np.zeros(slots // 2, np.uint8), np.zeros(16)
    for row in counted.groupBy("block").applyInPandas(level, "block int, packed binary, mass array<double>").collect():  # as bounded as the sketch
        packed[row["block"] * (BLOCK // 2) :][: BLOCK // 2] = np.frombuffer(row["packed"], np.uint8)
        mass += row["mass"]
    mass[:2] = 0  # n-grams of one document have no segment
    return Order(packed, mass)


def cut_sets(sets: DataFrame, order: Order) -> DataFrame:
    """_row, size, own (n-grams of one document), weight, prefix, segments of each set that may have a partner.

    weight is the mean level of its n-grams: that of an original is above its edited copies'.
    segments has a sorted array for each fragment; n-grams of one document are left out.
    """
    shared = sets.sparkSession.sparkContext.broadcast(order)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
    names = ["_row", "size", "own", "weight", "prefix", "segments"]

    def cut(batches):
        order = shared.value
        for batch in sliced(batches):
            out = []
            for row, blob in zip(batch.column("_row").to_pylist(), batch.column("grams")):
                g = np.frombuffer(blob.as_buffer(), np.uint64)
                size, levels = len(g), order.levels(g)
                weight = float(levels.mean()) if size else 0.0
                g, levels = g[levels > 1], levels[levels > 1]
                # sets with more of their own than this share too few with any other
                length = len(g) - need(size) + 1
                if not size or length <= 0:
                    continue
                prefix = g[np.lexsort((g, levels))[:length]].view(np.int64)
                of = order.fragments(g, levels)
                out.append((row, size, size - len(g), weight, prefix, [g[of == f].view(np.int64) for f in range(FRAGMENTS)]))
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "_row long, size long, own long, weight double, prefix array<long>, segments array<array<long>>"
    try:
        return materialized(sets.select("_row", "grams").mapInArrow(cut, schema))
    finally:
        shared.destroy()


def linked(pairs: DataFrame, cut: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, size_a, size_b) that link: partial overlaps of each fragment, summed for each pair."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct()
    in_pair = may_hit(cut.sparkSession, hit_slots(ends.select(*probes("_row")), ends.count(), times=1))
    segments = cut.filter(in_pair(*probes("_row"))).select("_row", F.posexplode("segments").alias("fragment", "segment")).filter(F.size("segment") > 0)
    first = pairs.join(segments.select(F.col("_row").alias("a"), "fragment", F.col("segment").alias("_sa")), "a")
    both = first.join(segments.select(F.col("_row").alias("b"), "fragment", F.col("segment").alias("_sb")), ["b", "fragment"])
    partial = both.select("a", "b", "size_a", "size_b", F.size(F.array_intersect("_sa", "_sb")).cast("long").alias("overlap"))
    summed = partial.groupBy("a", "b", "size_a", "size_b").agg(F.sum("overlap").alias("overlap"))
    return summed.filter(100 * F.col("overlap") >= PERCENT * (F.col("size_a") + F.col("size_b") - F.col("overlap"))).select("a", "b")


def _may_link(a: str, b: str):
    """Length filter, and position filter at a common n-gram, of the rows under two aliases."""
    sa, sb, pa_, pb = (F.col(f"{x}.{c}") for c in ("size", "at") for x in (a, b))
    both = F.least(sa - pa_, sb - pb)  # at the first common n-gram; another one needn't tell
    return (100 * F.least(sa, sb) >= PERCENT * F.greatest(sa, sb)) & ((100 + PERCENT) * both >= PERCENT * (sa + sb))


def _pair(a: str, b: str) -> list:
    swap = F.col(f"{a}._row") < F.col(f"{b}._row")
    pick = lambda x, y, c: F.when(swap, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    return [pick(b, a, "_row").alias("a"), pick(a, b, "_row").alias("b"), pick(b, a, "size").alias("size_a"), pick(a, b, "size").alias("size_b")]


def first_pairs(met: DataFrame, total: int) -> DataFrame:
    """Distinct pairs of the sets at an n-gram (met, with n): all of few; of many, each with the first centres."""
    small = met.filter(F.col("n") <= PAIRS)
    a, b = small.alias("a"), small.alias("b")
    pairs = a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a._row") > F.col("b._row"))).filter(_may_link("a", "b")).select(*_pair("a", "b"))
    large = met.filter(F.col("n") > PAIRS).withColumn("label", F.col("_row"))
    return pairs.unionByName(star_pairs(large, 0, total)).distinct()


def star_pairs(rows: DataFrame, turn: int, total: int) -> DataFrame:
    """Distinct pairs of each set with a few centres of another label at an n-gram; each turn has other centres."""
    # the first is the one of most weight, the others are drawn among those with the fewest n-grams of their own
    by = lambda i: F.xxhash64("_row", F.lit(turn * CENTRES + i)).alias("h")
    seen = lambda i: F.struct((F.col("own") / F.col("size") if i else -F.col("weight")).alias("w"), by(i), "_row", "size", "at", "label")
    centres = rows.groupBy("gram").agg(
        F.array_distinct(F.transform(F.array(*[F.min(seen(i)) for i in range(CENTRES)]), lambda c: F.struct(*[c[x].alias(x) for x in ("_row", "size", "at", "label")]))).alias("centres"),
        F.count("*").alias("_n"), F.min("label").alias("_l"), F.max("label").alias("_m"),
    ).filter("_l < _m").select("gram", "centres", "_n")
    starred = attach(rows, centres, "gram", "_n", total).select(F.struct("_row", "size", "at", "label").alias("a"), F.explode("centres").alias("b"))
    return starred.filter((F.col("a.label") != F.col("b.label")) & _may_link("a", "b")).select(*_pair("a", "b")).distinct()


def _labelled(met: DataFrame, labels: DataFrame) -> DataFrame:
    """met with label and n_label, the nodes that have it; a set without a link is a label of its own."""
    named = labels.join(labels.groupBy("label").agg(F.count("*").alias("n_label")), "label").select(F.col("node").alias("_row"), "label", "n_label")
    return materialized(met.join(named, "_row", "left").withColumns({"label": F.coalesce("label", "_row"), "n_label": F.coalesce("n_label", F.lit(1))}))


def missed_pairs(rows: DataFrame, total: int) -> DataFrame:
    """Distinct pairs of the labelled rows that meet, may link and have two labels."""
    two = rows.groupBy("gram").agg(F.count("*").alias("n"), F.min("label").alias("_l"), F.max("label").alias("_m"), F.max(F.struct("n_label", "label"))["label"].alias("major")).filter("_l < _m")
    member = materialized(attach(rows.drop("n"), two.select("gram", "n", "major"), "gram", "n", total))
    # of two that meet, one isn't of the largest component there; it is dealt to all tiles, the other lies in one
    tiles = F.ceil(F.col("n") / TILE).cast("long")
    x = member.withColumn("tile", F.pmod(F.xxhash64("_row"), tiles)).alias("x")
    y = member.filter("label != major").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1))).alias("y")
    met_at = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.tile") == F.col("y.tile")) & (F.col("x.label") != F.col("y.label"))
    once = (F.col("x.label") == F.col("x.major")) | (F.col("x._row") < F.col("y._row"))
    return x.join(y, met_at & once & _may_link("x", "y")).select(*_pair("x", "y")).distinct()


def node_labels(sets: DataFrame, nodes: DataFrame, n_grams: int) -> DataFrame:
    """node, label of the sets that have a link; nodes (_row) has one of each distinct set."""
    cut = cut_sets(sets, global_order(sets, n_grams))
    prefixes = cut.select("_row", "size", "own", "weight", "prefix").join(nodes.select("_row"), "_row", "left_semi")
    each = materialized(prefixes.select("_row", "size", "own", "weight", F.posexplode("prefix").alias("at", "gram")).withColumn("at", F.col("at") + F.col("own")))
    n_each = each.count()
    counts = materialized(each.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"))
    met = materialized(attach(each, counts, "gram", "n", n_each))
    tried = materialized(first_pairs(met, n_each))
    labels = components(materialized(linked(tried, cut)))
    joined = lambda found: components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(found))
    crowded = met.filter(F.col("n") > PAIRS)
    for turn in range(1, ROUNDS):
        new = materialized(star_pairs(_labelled(crowded, labels), turn, n_each).join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        found = materialized(linked(new, cut)) if not new.isEmpty() else new
        if found.isEmpty():
            break
        tried, labels = tried.unionByName(new), joined(found)
    more = materialized(missed_pairs(_labelled(met, labels), n_each).join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    return labels if more.isEmpty() else joined(linked(more, cut))


def ngram_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each row.

    component_id is the smallest doc_id that links reach. Null and empty texts, and texts
    without words, have no n-grams and are linked with nothing, not even with each other.
    Equal rows count each and link; a null doc_id is in its component and names it only if
    all of its doc_ids are null. An empty table gives no rows. Sets hold 64-bit hashes.
    """
    spark = docs.sparkSession

    def build():
        sets = materialized(gram_sets(docs))
        n_rows, n_grams = sets.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        key = F.struct("size", "set_a", "set_b").alias("set")
        narrow = sets.select("doc_id", "_row", key).filter("set.size > 0")
        nodes = materialized(narrow.groupBy("set").agg(F.min("doc_id").alias("least"), F.min("_row").alias("_row"), F.count("*").alias("n")))
        labels = scoped(spark, lambda: node_labels(sets, nodes, n_grams))
        named = nodes.join(labels.withColumnRenamed("node", "_row"), "_row", "left").withColumn("label", F.coalesce("label", "_row"))
        names = named.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("_size"))
        groups = materialized(attach(named.select("set", "n", "label"), names, "label", "_size", n_rows).select("set", "n", "component_id"))
        linkable = attach(narrow.select("doc_id", "set"), groups, "set", "n", n_rows).select("doc_id", F.col("set.size").alias("n_shingles"), "component_id")
        return linkable.unionByName(sets.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))

    with small_batches(spark):
        return scoped(spark, build)


def op13_vertical_jaccard_join(spark, sf_dir):
    """Components of documents whose 3-word shingles agree to 90 % of their union."""
    return ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
