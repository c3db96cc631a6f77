import hashlib
from collections import defaultdict

import numpy as np

from lotwise.llm import bloom
from lotwise.llm.exact_dedup import dedup_decisions, drop_exact_copies

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[sha(t)].append(d)
    out = []
    for key, ids in groups.items():
        keep, left = max(ids, key=lambda d: (d is not None, d)), True
        for d in ids:
            kept = d == keep and left
            left = left and not kept
            out.append((d, keep, len(ids), kept, key))
    return out


def decisions(docs):
    return sorted(map(tuple, dedup_decisions(docs)[0].select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_like_brute_force(odd_docs, odd_rows):
    assert decisions(odd_docs) == sorted(brute(odd_rows), key=str)


def test_full_filter_changes_nothing(odd_docs, odd_rows, monkeypatch):
    # a filter far too small finds all rows possibly repeated
    monkeypatch.setattr(bloom, "MAX_SLOTS", 1 << 10)
    monkeypatch.setattr(bloom, "BLOCK", 1 << 6)
    monkeypatch.setattr(bloom, "FLUSH_ROWS", 3)
    many = odd_docs
    for _ in range(3):
        many = many.unionByName(many)
    assert decisions(many) == sorted(brute(odd_rows * 8), key=str)


def test_filter_lets_unique_rows_pass(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(5000, "text 7")]
    decided, bits = dedup_decisions(spark.createDataFrame(rows, "doc_id long, text string"))
    assert decided.filter("kept").count() == 2000
    # two slots of the one repeated text, and some chance meetings
    assert 2 <= np.unpackbits(bits).sum() < 300


def test_hot_group(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    decided, _ = dedup_decisions(spark.createDataFrame(rows, "doc_id long, text string"))
    hot = decided.filter("group_size > 1")
    assert hot.count() == 1000 and {r["keep_id"] for r in hot.collect()} == {2997} and hot.filter("kept").count() == 1


def test_stage_keeps_whole_rows(clashing_docs, odd_rows, no_docs):
    out = drop_exact_copies(clashing_docs)
    assert out.columns == clashing_docs.columns
    kept = sorted(((r["doc_id"], sha(r["text"])) for r in out.collect()), key=str)
    assert kept == sorted({(k, s) for _, k, _, _, s in brute(odd_rows)}, key=str)
    assert {r["_maybe"] for r in out.collect()} == {"x"}
    assert drop_exact_copies(no_docs).count() == 0 and decisions(no_docs) == []
