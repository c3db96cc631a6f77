import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lotwise.llm import packing as P


@pytest.fixture(scope="module")
def reference_ids():
    import public_tokenizers

    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, P.END_ID]


def test_ids_are_the_tokenizers(reference_ids):
    enc = P.public_byte_bpe()
    for text in ("", " ", "a" * 5000, " " * 1_000_000, "x\n\n\n  y", "don't <|endoftext|> é 你好 \U0001f642", "\x00\x1c\x85 　"):
        assert [*enc.ids(text).tolist(), P.END_ID] == reference_ids(text)


def check(pieces, rows, reference_ids, window):
    """Every id in one piece, gapless sequences of at most a window, little padding."""
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at <= window
    got = Counter()
    starts = defaultdict(lambda: defaultdict(list))
    for p in pieces:
        starts[p["doc_id"], p["doc_tokens"]][p["start"]].append((p["length"], p["ids_crc32"]))
    for d, t, *_ in rows:
        got[d, tuple(reference_ids(t))] += 1
    for (d, ids), times in got.items():
        at = 0
        for _ in range(times):
            at = 0
            while at < len(ids):
                same = starts[d, len(ids)][at]
                fits = [x for x in same if zlib.crc32(np.array(ids[at : at + x[0]], "<u4").tobytes()) == x[1]]
                assert fits
                same.remove(fits[0])
                at += fits[0][0]
    assert not any(v for s in starts.values() for v in s.values())
    return seqs


def test_whole_documents(spark, odd_docs, odd_rows, clashing_docs, no_docs, reference_ids):
    pieces = P.packed(odd_docs, window=256).collect()
    seqs = check(pieces, odd_rows, reference_ids, 256)
    assert sum(sum(n for _, n in s) < 256 for s in seqs.values()) <= 4  # the last of each partition
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    check(P.packed(clashing_docs, with_ids=False).collect(), odd_rows, reference_ids, 2048)
    assert P.packed(no_docs).count() == 0


def test_shards_carry_the_open_window(odd_docs, odd_rows, reference_ids, monkeypatch):
    monkeypatch.setattr(P, "SHARD_TOKENS", 500)
    seqs = check(P.packed(odd_docs, window=128).collect(), odd_rows, reference_ids, 128)
    assert sum(sum(n for _, n in s) < 128 for s in seqs.values()) <= 4


def corpus_of(docs):
    df = Counter(int(t) for d in docs for t in set(np.asarray(d).tolist()))
    counts = np.zeros(max(df) + 1, np.int64)
    counts[list(df)] = list(df.values())
    return P.Statistics(len(docs), sum(map(len, docs)) / len(docs), counts)


def bm25(corpus, seed, d):
    """Score of d for all terms of seed, term by term."""
    tf = Counter(d.tolist())
    score = 0.0
    for t in set(seed.tolist()) & set(tf):
        idf = np.log1p((corpus.n - corpus.df[t] + 0.5) / (corpus.df[t] + 0.5))
        score += idf * tf[t] * (P.K1 + 1) / (tf[t] + P.K1 * (1 - P.B + P.B * len(d) / corpus.mean))
    return score


def samples():
    rng = np.random.default_rng(3)
    yield [rng.zipf(1.5, rng.integers(5, 12)) % 50 for _ in range(40)]
    docs = [rng.zipf(1.3, rng.integers(30, 60)) % 200 for _ in range(40)]
    docs[0] = np.append(np.repeat(np.arange(1000, 1040), 3), 2000)  # more terms than any other
    yield docs + [docs[0][:60], np.array([2000])]


@pytest.mark.parametrize("share", [1, 4, 8, 1000])
def test_neighbours_like_brute_force(share, monkeypatch):
    """All unused documents that share any term, by the whole score, whichever form the index holds terms in."""
    monkeypatch.setattr(P, "COMMON_SHARE", share)
    rng = np.random.default_rng(2)
    for docs in samples():
        # a shard of a larger corpus
        corpus = corpus_of(docs + [rng.zipf(1.2, 80) % 3000 for _ in range(60)])
        index = P.Index(docs, corpus)
        for seed in range(len(docs)):
            unused = rng.random(len(docs)) < 0.8
            unused[seed] = False
            found = index.neighbours(seed, unused).tolist()
            scores = [bm25(corpus, docs[seed], d) for d in docs]
            assert set(found) == {d for d in range(len(docs)) if unused[d] and scores[d] > 0}
            assert all(scores[a] >= scores[b] - 1e-3 for a, b in zip(found, found[1:]))


def plain_fill(docs, window):
    """Windows as lists of (document, start, length), by the rule, one decision at a time."""
    corpus = corpus_of(docs)
    unused, windows, open_ = set(range(len(docs))), [[]], 0

    def put(d, start):
        nonlocal open_
        n = min(len(docs[d]) - start, window - open_)
        windows[-1].append((d, start, n))
        open_ += n
        if open_ == window:
            windows.append([])
            open_ = 0
        return start + n

    seed = None
    while unused or seed is not None:
        if seed is None:
            seed = min(unused)
            unused.remove(seed)
        at = 0
        while at < len(docs[seed]):
            at = put(seed, at)
        last, seed = seed, None
        if not open_:
            continue
        scored = sorted((-bm25(corpus, docs[last], docs[d]), d) for d in unused if bm25(corpus, docs[last], docs[d]) > 0)
        for _, d in scored:
            if len(docs[d]) <= window - open_:
                put(d, 0)
                unused.remove(d)
                if not open_:
                    break
        left = [d for _, d in scored if d in unused]
        if open_ and left:
            seed = left[0]
            unused.remove(seed)
    return [w for w in windows if w]


def test_fill_like_a_plain_one():
    rng = np.random.default_rng(7)
    for _ in range(5):
        docs = [rng.zipf(1.4, rng.integers(3, 90)) % 300 for _ in range(60)]
        found = defaultdict(list)
        for doc, start, ids, n, sequence, offset in P.Packer(0, corpus_of(docs), 64).pack(list(enumerate(docs))):
            assert n == len(docs[doc]) and offset == sum(x[2] for x in found[sequence])
            assert ids.tolist() == docs[doc][start : start + len(ids)].tolist()
            found[sequence].append((doc, start, len(ids)))
        assert [found[k] for k in sorted(found)] == plain_fill(docs, 64)


def test_statistics_cover_all_documents(spark, odd_docs, odd_rows, no_docs, reference_ids):
    got = P.statistics(P.tokenised(odd_docs))
    want = corpus_of([np.array(reference_ids(r[1])) for r in odd_rows])
    assert got.n == want.n and abs(got.mean - want.mean) < 1e-9 and got.df.tolist() == want.df.tolist()
    assert P.statistics(P.tokenised(no_docs)).n == 0
