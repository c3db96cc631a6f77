import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.llm import order_minhash as O


def kmer_hashes(text, k=O.K):
    """The fast code's hash of each k-mer, one at a time."""
    k = min(k, len(text))
    out = []
    for i in range(len(text) - k + 1):
        piece = [ord(c) + 1 for c in text[i : i + k]]
        h, width, factor = piece, 1, int(O._ODD[0])
        while width < k:
            step = min(width, k - width)
            h = [(h[j] * factor + h[j + step]) % (1 << 64) for j in range(len(h) - step)]
            width, factor = width + step, (factor * factor + 2) % (1 << 64)
        out.append(int(O._mix(np.array(h, np.uint64))[0]))
    return out


def brute(text, size=O.TUPLE, bins=O.BINS):
    seen, keyed = {}, []
    for i, h in enumerate(kmer_hashes(text) if text else []):
        n = seen.get(h, 0)
        seen[h] = n + 1
        keyed.append((h if not n else int(O._mix(np.array([(h + n * int(O._ODD[0])) % (1 << 64)], np.uint64))[0]), i))
    out = []
    for b in range(bins):
        least = sorted((k, i) for k, i in keyed if k >> (64 - bins.bit_length() + 1) == b)[:size]
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for j in range(size):
                chosen = sorted(i for _, i in least)
                key = {i: k for k, i in least}[chosen[j]] if j < len(chosen) else 0
                total = O._mix(np.array([total * O._ODD[0] + np.uint64(key) + np.uint64(j + 1)]))[0]
        out.append(max(int(total) >> 32, 1) if least else 0)
    return out


@given(st.text(alphabet="ab é\U0001f642", max_size=80))
@settings(max_examples=60, deadline=None)
def test_like_plain_selection(text):
    assert O.fingerprint(text).tolist() == brute(text)


def test_order_matters_to_it():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(200)]
    text = " ".join(words)
    near = " ".join(words[:-20])
    moved = " ".join(words[100:] + words[:100])
    f = O.fingerprint(text)
    assert O.likeness(f, f) == 1.0
    assert O.likeness(f, O.fingerprint(near)) > 0.6
    # as many common k-mers, in another order
    assert O.likeness(f, O.fingerprint(moved)) < O.likeness(f, O.fingerprint(near))
    assert O.likeness(f, O.fingerprint("".join(rnd.choice("ijkl ") for _ in range(2000)))) < 0.05
    assert O.likeness(O.fingerprint(""), O.fingerprint("")) == 1.0 and O.likeness(O.fingerprint(""), f) == 0.0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, zlib.crc32((r[1] or "").encode()), r[1] or ""))
    out = []
    for a, b in zip(order, order[1:] + order[:1]):
        t, n = a[1] or "", b[1] or ""
        cut = len(t) // 4
        e = t[: len(t) - cut] + n[:cut]
        f, fe, fn = O.fingerprint(t), O.fingerprint(e), O.fingerprint(n)
        out.append((a[0], len(t), hashlib.sha256(e.encode()).hexdigest(), O.hexadecimal(f), O.hexadecimal(fe), O.likeness(f, fe), O.likeness(f, fn)))
    return sorted(out, key=str)


def test_odd_documents(odd_docs, odd_rows, clashing_docs, no_docs):
    run = lambda df: sorted(map(tuple, O.edited_fingerprints(df).collect()), key=str)
    assert run(odd_docs) == expected(odd_rows)
    assert run(clashing_docs) == expected(odd_rows)
    assert run(no_docs) == []


def test_rows_of_one_doc_id_fill_many_runs(spark, words):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, None if i % 50 == 0 else "same" if i % 4 == 0 else t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, O.edited_fingerprints(docs).collect()), key=str) == expected(rows)
    runs = O.with_next(docs, 12).filter("not _tail").groupBy("_run").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).collect()
    assert len(runs) == 12 and max(r["n"] for r in runs) < 60


def test_one_document_follows_itself(spark):
    one = spark.createDataFrame([(5, "abcdefgh" * 4)], "doc_id long, text string")
    assert [tuple(r) for r in O.edited_fingerprints(one).collect()] == expected([(5, "abcdefgh" * 4)])
