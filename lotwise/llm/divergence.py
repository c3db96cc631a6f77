"""Divergence of the sources of each language: pairs of sources, and the terms that stand out.

Only terms that occur in a group are held. What a group's other terms add to a pair of
groups is the same for each of them, so a pair is that times the vocabulary, corrected for
the terms that one or both have. The first terms of a group come by radix selection:
histograms over the bits of the values narrow down, in all tasks at once, where the kth
value lies, and ties there are narrowed down by the bytes of the terms.
"""

from __future__ import annotations

import os.path
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, materialized, split_pieces, table

SCALE = 1_000_000_000
#: Documents of a language that a term must be in.
LEAST_DOCS = 3
TOP = 200
#: Different (group, term)s that a task counts before it hands them on.
HELD_TERMS = 1 << 18
#: Bits of a value that one histogram tells apart.
DIGIT = 12
#: Rows of a group, at the kth value, that are sorted rather than narrowed down further.
FINISH = 1024
#: Sources of a tile of pair sums, and tiles a task holds before it hands them on.
TILE = 256
HELD_TILES = 64

# A-Z become a-z, a-z and what is beyond ASCII stay, the rest separates
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), n_lang and df_lang (its documents in the language), of all terms.

    Null lang, source and text count as ''. Tasks sum what they read before it shuffles.
    """

    def count(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def flush():
            columns = [[], [], [], [], []]
            for (lang, source), (n, df) in held.items():
                columns[0] += [lang] * len(n)
                columns[1] += [source] * len(n)
                columns[2] += n
                columns[3] += n.values()
                columns[4] += (df[t] for t in n)
            held.clear()
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["lang", "source", "term", "n", "df"])

        size = 0
        for batch in batches:
            langs, sources, texts = (batch.column(c) for c in ("lang", "source", "text"))
            for i in range(batch.num_rows):
                n, df = held.setdefault((langs[i].as_py(), sources[i].as_py()), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in split_pieces(texts[i].as_py(), _TERM_BYTES):
                    n.update(terms)
                    seen.update(terms)
                df.update(seen)
                size += len(n) - before
                if size >= HELD_TERMS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    partial = read.mapInArrow(count, "lang string, source string, term string, n long, df long")
    # dealt by language and term, which serves the sums of a language too; a term has one row for each source
    summed = partial.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_term = Window.partitionBy("lang", "term")
    return summed.select("lang", "source", "term", "n", F.sum("n").over(of_term).alias("n_lang"), F.sum("df").over(of_term).alias("df_lang"))


def _p(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + v)), in decimals, as counts of a large corpus are beyond a long's range there."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(n + 1), wide(total + v)) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, gid (from 0 in its language), total, terms, v, lang_total, p0 of each group.

    v is the number of the language's kept terms; p0 is p of a term that the group hasn't
    got, null where v is 0. Pairs of a language's groups are all wanted, so its groups are
    few beside its pairs.
    """
    occurring = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    langs = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    vocabulary = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(vocabulary, "lang", "left")
    rows = rows.select("lang", "source", *[zero(c).alias(c) for c in ("total", "terms", "v", "lang_total")])
    p0 = F.when(F.col("v") > 0, _p(F.lit(0).cast("long"), F.col("total"), F.col("v")))
    gid = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return rows.select("*", gid.alias("gid"), p0.alias("p0"))


def _scored(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, gid, term, p, q, p0 of each kept term that a group has; q is the language's."""
    of = F.struct("lang", "source").alias("of")
    n_rows = groups.agg(F.coalesce(F.sum("terms"), F.lit(0))).first()[0]
    some = groups.select(of, "gid", "total", "terms", "v", "lang_total", "p0")
    rows = attach(kept.select(of, "term", "n", "n_lang"), some, "of", "terms", n_rows)
    return rows.select(
        F.col("of.lang").alias("lang"), "gid", "term",
        _p(F.col("n"), F.col("total"), F.col("v")).alias("p"), _p(F.col("n_lang"), F.col("lang_total"), F.col("v")).alias("q"), "p0",
    )


def pair_corrections(scored: DataFrame) -> DataFrame:
    """lang, g, h, value: for terms that both groups have, what the sums over one group's terms get wrong.

    Rows of a term meet in one task, which holds their pairs only as sums over terms.
    """

    def div(a, b):
        return (a - b) ** 2 // b

    def correct(batches):
        tiles: dict[tuple[int, int], np.ndarray] = {}
        lang = None

        def flush():
            g, h, value = [], [], []
            for (i, j), sums in tiles.items():
                x, y = np.nonzero(sums)
                g.append(x + i * TILE)
                h.append(y + j * TILE)
                value.append(sums[x, y])
            tiles.clear()
            join = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64)
            columns = [pa.array([lang] * sum(map(len, g)), pa.string()), *[pa.array(join(c), pa.int64()) for c in (g, h, value)]]
            return pa.RecordBatch.from_arrays(columns, ["lang", "g", "h", "value"])

        def add(gid, p, p0):
            order = np.argsort(gid)
            gid, p, p0 = gid[order], p[order], p0[order]
            cuts = np.flatnonzero(np.diff(gid // TILE)) + 1
            parts = list(zip(np.split(gid, cuts), np.split(p, cuts), np.split(p0, cuts)))
            for ga, pa_, za in parts:
                a, z = pa_[:, None], za[:, None]
                for gb, pb, zb in parts:
                    key = (int(ga[0]) // TILE, int(gb[0]) // TILE)
                    if key not in tiles:
                        if len(tiles) >= HELD_TILES:
                            yield flush()
                        tiles[key] = np.zeros((TILE, TILE), np.int64)
                    tiles[key][np.ix_(ga % TILE, gb % TILE)] += div(a, pb) - div(a, zb) - div(z, pb) + div(z, zb)

        held = None  # the last term's rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, terms = batch.column("lang").to_pylist(), batch.column("term").to_pylist()
            numbers = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("gid", "p", "p0")]
            starts = [i for i in range(batch.num_rows) if not i or terms[i] != terms[i - 1] or langs[i] != langs[i - 1]]
            for at, end in zip(starts, [*starts[1:], batch.num_rows]):
                rows = [c[at:end] for c in numbers]
                if held and held[0] == (langs[at], terms[at]):
                    held = (held[0], [np.concatenate(x) for x in zip(held[1], rows)])
                    continue
                if held:
                    yield from add(*held[1])
                if lang != langs[at]:
                    if tiles:
                        yield flush()
                    lang = langs[at]
                held = ((langs[at], terms[at]), rows)
        if held:
            yield from add(*held[1])
        if tiles:
            yield flush()

    dealt = scored.select("lang", "term", "gid", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(correct, "lang string, g long, h long, value long").filter("g != h")


def pair_values(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, g, h, value for all ordered pairs of different groups of a language.

    All terms as if neither group had them, then terms of one group by how many have its
    p, then terms of both. Pairs are made tile by tile, so a language's are dealt over tasks.
    """
    tiles = F.ceil(F.count("*").over(Window.partitionBy("lang")) / TILE).cast("long")
    own = groups.select("lang", "gid", "p0", "v", F.expr(f"gid div {TILE}").alias("tile"), tiles.alias("tiles"))
    other = own.select(F.col("lang").alias("_lang"), F.col("gid").alias("h"), F.col("p0").alias("h0"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("_tile"))
    met = (F.col("lang") == F.col("_lang")) & (F.col("tile") == F.col("_tile")) & (F.col("gid") != F.col("h"))
    base = own.join(other, met).select("lang", F.col("gid").cast("long").alias("g"), F.col("h").cast("long").alias("h"), F.coalesce(F.col("v") * _f(F.col("p0"), F.col("h0")), F.lit(0)).alias("value"))
    held = scored.groupBy("lang", "gid", "p", "p0").agg(F.count("*").alias("m")).withColumn("tile", F.expr(f"gid div {TILE}"))
    p, p0, h0, m = (F.col(c) for c in ("p", "p0", "h0", "m"))
    sides = F.explode(F.array(
        F.struct(F.col("gid").cast("long").alias("g"), F.col("h").cast("long").alias("h"), (m * (_f(p, h0) - _f(p0, h0))).alias("value")),
        F.struct(F.col("h").cast("long").alias("g"), F.col("gid").cast("long").alias("h"), (m * (_f(h0, p) - _f(h0, p0))).alias("value")),
    ))
    one = held.join(other, met).select("lang", sides.alias("s")).select("lang", "s.g", "s.h", "s.value")
    return base.unionByName(one).unionByName(pair_corrections(scored)).groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def radix_top(rows: DataFrame, keys: list[str], value: str, item: str, k: int, finish: int = FINISH) -> DataFrame:
    """rows with rank, from 1 to k in each group of keys: value (long) descending, then item in UTF-8 bytes.

    A group's kth value lies between `low` and `high`, among `n` rows of which `need` are
    wanted; each pass counts those by their next bits, and takes the digit that the kth
    falls in. Where they have one value, the next byte after what their items begin with
    alike is counted. At `finish` rows the rest is sorted with what is above them.
    Items of a group differ; null keys, values and items are no rows.
    """

    @F.pandas_udf("long")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([len(os.path.commonprefix([x.encode(), y.encode()])) for x, y in zip(a, b)], dtype="int64")

    low, high, need, n = (F.col(c) for c in ("_low", "_high", "_need", "_n"))
    state = rows.groupBy(*keys).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.min(item).alias("_first"), F.max(item).alias("_last"), F.count("*").alias("_n"), F.lit(k).cast("long").alias("_need")
    )
    # items decide only where all of the bucket's values are one
    state = materialized(state.select(*keys, "_low", "_high", "_first", "_last", "_n", F.least(need, n).alias("_need"), F.lit(False).alias("_by_item")))
    going = (n > finish) & (need < n)
    while not state.filter(going).isEmpty():
        # bits below the digit
        width = high - low
        shift = F.greatest(F.length(F.bin(width)) - DIGIT, F.lit(0))
        open_ = state.filter(going).withColumns({"_shift": shift, "_alike": alike("_first", "_last")})
        in_bucket = F.col(value).between(low, high) & (~F.col("_by_item") | F.col(item).between(F.col("_first"), F.col("_last")))
        met = rows.join(open_.select(*keys, "_low", "_high", "_first", "_last", "_need", "_shift", "_alike", "_by_item"), keys).filter(in_bucket)
        # the larger values first, the smaller bytes first
        byte = F.conv(F.hex(F.substring(F.encode(item, "UTF-8"), F.col("_alike") + 1, F.lit(1))), 16, 10).cast("long")
        digit = F.when(low == high, F.coalesce(byte, F.lit(-1).cast("long"))).otherwise(-F.call_function("shiftright", F.col(value) - low, F.col("_shift")))
        counted = met.withColumn("_digit", digit).groupBy(*keys, "_digit").agg(
            F.count("*").alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.min(item).alias("_f"), F.max(item).alias("_l"),
            F.first("_need").alias("_need"), F.first(low == high).alias("_tied"),
        )
        # at most 2 to the DIGIT rows a group
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found = counted.withColumn("_before", before).filter((F.col("_before") < need) & (F.col("_before") + n >= need)).select(
            *keys, F.col("_lo").alias("_low"), F.col("_hi").alias("_high"), F.col("_f").alias("_first"), F.col("_l").alias("_last"), "_n", (need - F.col("_before")).alias("_need"), F.col("_tied").alias("_by_item")
        )
        state = materialized(state.filter(~going).unionByName(found))
    # of one group at most k rows above the bucket, and the bucket
    last = state.select(*keys, "_low", "_high", "_last", "_by_item")
    wanted = (F.col(value) > high) | ((F.col(value) >= low) & (~F.col("_by_item") | (F.col(item) <= F.col("_last"))))
    ranked = rows.join(last, keys).filter(wanted).select(*rows.columns, F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), item)).alias("rank"))
    return ranked.filter(F.col("rank") <= k)


def source_divergence(docs: DataFrame, top: int = TOP, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: other sources of the language, and terms over its average.

    Null lang, source and text count as ''; a group without terms, and a language without
    kept ones, have pairs too. Repeated rows count each. An empty table gives no rows.
    """
    kept = materialized(term_counts(docs).filter(F.col("df_lang") >= least_docs).drop("df_lang"))
    groups = materialized(_groups(docs, kept))
    scored = materialized(_scored(kept, groups))
    names = groups.select("lang", "gid", "source")
    pairs = pair_values(scored, groups)
    pairs = pairs.join(names.withColumnRenamed("gid", "g"), ["lang", "g"]).join(names.select("lang", F.col("gid").alias("h"), F.col("source").alias("item")), ["lang", "h"])
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    over = materialized(scored.filter("p > q").select("lang", "gid", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value")))
    terms = radix_top(over, ["lang", "gid"], "value", "item", top).join(names, ["lang", "gid"])
    return pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op11_radix_divergence(spark, sf_dir):
    """Pairs and terms of all sources of documents."""
    return source_divergence(table(spark, sf_dir, "documents"))


SQL = {
    "op11_radix_divergence": r"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY ALL),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN totals t USING (lang, source) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM grid WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200"""
}
