import zlib

from pyspark.sql import functions as F

from lotwise.llm.sharding import contiguous_shards, document_shards


def brute(rows, n_shards):
    sized = sorted(
        ((d is not None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    )
    total, before, out, slots = sum(s[2] for s in sized), 0, [], [0] * n_shards
    for known, d, size, crc in sized:
        shard = min(n_shards - 1, (2 * before + size) * n_shards // (2 * total))
        out.append((d if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return out


def rows_of(df):
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect()), key=str)


def test_like_brute_force(spark, odd_docs, odd_rows):
    assert rows_of(document_shards(odd_docs, 8)) == sorted(brute(odd_rows, 8), key=str)


def test_clashing_and_empty(clashing_docs, no_docs, odd_rows):
    assert rows_of(document_shards(clashing_docs, 3)) == sorted(brute(odd_rows, 3), key=str)
    assert document_shards(no_docs, 8).count() == 0


def test_shards_are_near_equal(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 17 + 1).alias("size"), F.lit(0).cast("long").alias("text_crc32"))
    found = contiguous_shards(rows, "doc_id", "size", 8).groupBy("shard").agg(F.sum("size").alias("s"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    assert len(found) == 8 and all(r["m"] == r["n"] - 1 for r in found)
    assert max(r["s"] for r in found) - min(r["s"] for r in found) <= 34


def test_one_row(spark):
    one = spark.createDataFrame([(7, "abc")], "doc_id long, text string")
    assert rows_of(document_shards(one, 8)) == [(7, 4, zlib.crc32(b"abc"), 4, 0)]
