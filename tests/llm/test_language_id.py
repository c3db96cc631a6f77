import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np

from lotwise.llm import language_id as L

TOYS = {"xx": ["lomo", "pelta", "runo", "saki"], "yy": ["zwrk", "brzt", "krst", "wlk"]}


def corpus(spark, n=300):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(TOYS))
        rows.append((i, " ".join(rnd.choice(TOYS[lang]) for _ in range(rnd.randint(1, 60))), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_held_out_accuracy_and_no_leak(spark):
    docs, rows = corpus(spark)
    # labels of held-out rows are wrong on purpose: nothing may be learned from them
    wrong = docs.replace({"xx": "bad", "yy": "bad"}, subset="lang").join(docs.select("doc_id"), "doc_id")
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    mixed = docs.filter(~held).unionByName(wrong.filter(held))
    langs, matrix = L.train(mixed)
    assert langs == ["xx", "yy"] and matrix.shape == (2, L.BUCKETS + 1)
    truth = {r[0]: r[2] for r in rows}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.predict(docs.select("doc_id", "text"), langs, matrix).collect()}
    tested = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(tested) > 40 and all(got[i][0] == truth[i] for i in tested) and all(0 < s <= 1 for _, s in got.values())


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    langs, matrix = L.train(odd_docs)
    got = {(r["doc_id"], r["text"]): r for r in L.predict(odd_docs, langs, matrix).collect()}
    for key in ((100, None), (101, ""), (102, "   \n "), (107, "!!! 123")):
        assert (got[key]["lang_pred"], got[key]["score"]) == ("und", 0.0)
    assert got[(103, "é" * 5)]["lang_pred"] == "fr"
    assert L.predict(clashing_docs.select("doc_id", "text", "n"), langs, matrix).count() == odd_docs.count()
    assert L.train(no_docs)[0] == []
    assert {r["lang_pred"] for r in L.predict(odd_docs, [], matrix).collect()} == {"und"}


def plain_grams(text):
    """Buckets of a text's n-grams, by the letter."""
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    padded = f" {' '.join(kept.split())} "
    found, wide = [], 1 << 64
    for n in L.GRAMS:
        for at in range(len(padded) - n + 1):
            h = ord(padded[at]) + (n << 21)
            for c in padded[at + 1 : at + n]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) % wide
            found.append((h * 0xD6E8FEB86659FD93 % wide) >> 48)
    return found


def test_like_plain_naive_bayes(spark):
    """Counts, log probabilities and scores one n-gram at a time, for all rows."""
    docs, rows = corpus(spark, 120)
    langs, matrix = L.train(docs)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    counts = {lang: Counter(g for _, t, k in learned if k == lang for g in plain_grams(t)) for lang in langs}

    def total(lang, grams):
        size = sum(counts[lang].values()) + L.SMOOTHING * L.BUCKETS
        return math.log(sum(k == lang for *_, k in learned) / len(learned)) + sum(math.log((counts[lang][g] + L.SMOOTHING) / size) for g in grams)

    odd = [(1000, "Lomo, 123 ZWRK!"), (1001, "é"), (1002, "pelta " * 3000)]
    asked = spark.createDataFrame([(r[0], r[1]) for r in rows] + odd, "doc_id long, text string")
    for r in L.predict(asked, langs, matrix).collect():
        grams = plain_grams(r["text"])
        logs = [total(lang, grams) for lang in langs]
        best = max(logs)
        score = 1 / sum(math.exp((x - best) / len(grams) ** 0.5) if (x - best) / len(grams) ** 0.5 > -700 else 0 for x in logs)
        assert abs(r["score"] - score) < 1e-4
        if max(logs) - min(logs) > 1e-3:
            assert r["lang_pred"] == langs[logs.index(best)]


def test_each_ngram_is_in_one_chunk(spark, monkeypatch):
    for text in ("lomo pelta runo saki " * 50, "...a ... b" * 90, "", "é", "   x" * 64):
        whole = sorted(plain_grams(text))
        assert sorted(np.concatenate([*L._chunks(text), []]).astype(int).tolist()) == whole
        with monkeypatch.context() as m:
            m.setattr(L, "CHUNK", 7)
            assert sorted(np.concatenate([*L._chunks(text), []]).astype(int).tolist()) == whole


def test_sample_of_any_size():
    for n in (1, 2000, 2001, 10**6, 2 * 10**9, 2_100_000_000, 10**13):
        got = L.threshold(2000, n)
        assert 0 < got <= L.HASHES and abs(got / L.HASHES * n - min(n, 2000)) < 0.01


def test_clashing_names(spark, odd_docs, clashing_docs):
    from pyspark.sql import functions as F

    langs, matrix = L.train(odd_docs)
    plain = L.predict(odd_docs, langs, matrix)
    got = L.predict(clashing_docs.withColumn("_lang", F.lit("x")), langs, matrix)
    assert got.columns.count("lang_pred") == got.columns.count("score") == 1 and got.filter("_lang = 'x' and text_sha256 = 'x'").count() == odd_docs.count()
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "text", "lang_pred", "score").collect()), key=str)
    assert rows(got) == rows(plain)
