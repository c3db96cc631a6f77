import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from lotwise.llm import near_dedup, simhash
from lotwise.llm.components import components
from lotwise.llm.simhash import Pigeonring, _signed, near_components


def union(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_like_union_find(spark):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(200)]  # a chain
    links += [(5000, 5001 + i) for i in range(500)] + [(7, 7), (3, 9), (9, 3)]  # a hub, a loop, a reversed pair
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union({x for p in links for x in p}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: want[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint():
    assert simhash.simhash(simhash.hashes("", 3)) == simhash.simhash(simhash.hashes(" \t\n", 3)) == 0
    assert simhash.simhash(simhash.hashes("one two", 3)) == _signed(xxhash.xxh64_intdigest("one two", 42))
    words = "a b c d e a b c f".split()
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(7)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > 7)
    assert simhash.simhash(simhash.hashes(" a b\x0bc d\x0ce a b c f ", 3)) == _signed(want)
    # U+00A0 is no separator
    assert len(simhash.hashes("a\xa0b c d", 3)) == 1


@pytest.mark.parametrize("max_bits", [1, 2, 3, 5])
def test_pigeonring_loses_no_pair(max_bits):
    ring, rnd = Pigeonring(max_bits), random.Random(max_bits)
    for _ in range(500):
        differ = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, max_bits)))
        starts = [s for s in range(ring.segments) if all(bin(differ & m).count("1") <= b for m, b in ring.chains[s])]
        assert starts and all(not differ & ring.key(s) for s in starts)
    assert all(bin(ring.key(s)).count("1") >= 64 // ring.segments for s in range(ring.segments))


def brute(rows, max_bits=2):
    fps = sorted({f for _, f in rows})
    v = np.array(fps, np.int64).view(np.uint64)
    links = [(fps[i], fps[j]) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(v[:i] ^ v[i]) <= max_bits)]
    label, least = union(fps, links), defaultdict(list)
    for d, f in rows:
        least[label[f]] += [d] * (d is not None)
    return sorted(((d, f, min(least[label[f]], default=None)) for d, f in rows), key=str)


@pytest.mark.parametrize("bucket,bits", [(64, 2), (3, 2), (3, 1), (3, 3), (64, 3)])
def test_components_of_crowds(spark, monkeypatch, bucket, bits):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd, rows = random.Random(1), []
    for c in range(5):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rnd.randrange(6)):
                x ^= 1 << rnd.randrange(64)
            rows.append((len(rows), _signed(x)))
    rows += [(1000 + i, rows[0][1]) for i in range(400)] + [(None, rows[1][1]), (None, 12345), (0, 777)]
    got = near_components(spark.createDataFrame(rows, "doc_id long, fp long").repartition(3), bits)
    assert sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in got.collect()), key=str) == brute(rows, bits)


def test_query_on_odd_documents(odd_docs, odd_rows, clashing_docs, no_docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = brute([(d, simhash.simhash(simhash.hashes((t or "").translate(lower), 3))) for d, t, *_ in odd_rows])
    for docs in (odd_docs, clashing_docs):
        rows = simhash.fingerprinted(docs.select("doc_id", "text"), 3).select("doc_id", "fp")
        assert sorted(((r["doc_id"], r["fp"], r["component_id"]) for r in near_components(rows, 2).collect()), key=str) == want
    assert near_components(simhash.fingerprinted(no_docs, 3).select("doc_id", "fp"), 2).count() == 0


def near_brute(rows, similarity=0.8):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = [set(simhash.hashes((t or "").translate(lower), 5).tolist()) for _, t, *_ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    groups = defaultdict(list)
    for i, g in union(range(len(rows)), links).items():
        groups[g].append(rows[i][:2])
    return [min(g, key=lambda r: (r[0] is not None, r[0] or 0)) for g in groups.values()]


@pytest.mark.parametrize("pairs", [16, 2])
def test_near_copies_go(spark, words, monkeypatch, pairs):
    monkeypatch.setattr(near_dedup, "PAIRS", pairs)
    rnd, rows = random.Random(9), []
    for g in range(8):
        base = [rnd.choice(words) for _ in range(rnd.randint(60, 300))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rnd.randint(0, 12)):
            edited = list(base)
            for _ in range(max(1, len(base) // 100)):
                edited[rnd.randrange(len(edited))] = rnd.choice(words)
            rows.append((len(rows), " ".join(edited)))
    passage = " ".join(rnd.choice(words) for _ in range(55))
    for _ in range(60):  # a passage that many share doesn't make them copies
        rows.append((len(rows), " ".join(rnd.choice(words) for _ in range(120)) + " " + passage))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r["doc_id"] for r in near_dedup.drop_near_copies(docs).collect()}
    want = {d for d, _ in near_brute(rows)}
    assert set(range(len(rows) - 60, len(rows))) <= kept
    assert kept == want


@pytest.mark.parametrize("first_pass_only", [False, True])
def test_star_of_near_copies(spark, words, monkeypatch, first_pass_only):
    """One text and copies of it, each near to it and not near to each other. The first pass finds the centre."""
    if first_pass_only:
        monkeypatch.setattr(near_dedup, "missed", lambda *_: spark.createDataFrame([], "a long, b long"))
    rnd = random.Random(12)
    base = [rnd.choice(words) for _ in range(400)]
    rows = []
    for i in range(150):
        edited = list(base)
        for k in range(7):
            edited[57 * k + rnd.randrange(50)] = f"edit{i}x{k}"
        rows.append((i, " ".join(edited)))
    rows.insert(90, (1000, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert [r["doc_id"] for r in near_dedup.drop_near_copies(docs).collect()] == [d for d, _ in near_brute(rows)] == [0]


def test_repeats_do_not_count(spark, words):
    """Texts with one set of shingles have one fingerprint, however often a line is repeated."""
    rnd, rows = random.Random(14), []
    for g in range(20):
        base, line = ([rnd.choice(words) for _ in range(n)] for n in (300, 8))
        rows += [(len(rows) + i, " ".join(base + line * n)) for i, n in enumerate((2, 50, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    fps = defaultdict(set)
    for r in near_dedup.sketches(docs, 5).collect():
        fps[r["doc_id"] // 3].add(r["fp"])
    assert len(fps) == 20 and all(len(x) == 1 for x in fps.values())
    assert {r["doc_id"] for r in near_dedup.drop_near_copies(docs).collect()} == {d for d, _ in near_brute(rows)} == set(range(0, 60, 3))


def test_second_pass_needs_no_first(spark, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "near_links", lambda sketched, *_: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(near_dedup, "TILE", 8)
    monkeypatch.setattr(near_dedup, "COMMON", 100)
    rnd, rows = random.Random(13), []
    for g in range(30):
        base = [rnd.choice(words) for _ in range(rnd.randint(1, 120))]
        for _ in range(rnd.randint(1, 30)):
            edited = list(base)
            for _ in range(rnd.randint(0, 3)):
                edited[rnd.randrange(len(edited))] = rnd.choice(words)
            rows.append((len(rows), " ".join(edited[: rnd.randint(len(edited) * 9 // 10, len(edited))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in near_dedup.drop_near_copies(docs).collect()} == {d for d, _ in near_brute(rows)}


def test_near_copies_of_odd_documents(odd_docs, odd_rows, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs):
        out = near_dedup.drop_near_copies(docs)
        assert out.columns == docs.columns
        assert {(r["doc_id"], r["text"]) for r in out.collect()} == set(near_brute(odd_rows))
    assert near_dedup.drop_near_copies(no_docs).count() == 0
