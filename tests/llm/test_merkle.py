import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lotwise.llm import merkle
from lotwise.llm.merkle import auth_paths, block_root, cut_path, depth, fold, manifest, op12_merkle_manifest
from lotwise.llm.shared import lower_ascii

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def picked():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower_ascii(F.col("text")))


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, pos):
    out = []
    for nodes in levels[:-1]:
        out.append((nodes[pos // 8 * 8 : pos], nodes[pos + 1 : pos // 8 * 8 + 8]))
        pos //= 8
    return out


def brute(rows):
    by_lang = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf(doc_id, text, lang, source, n_chars)
        changed = text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        other = leaf(doc_id, text.translate(LOWER), lang, source, n_chars) if changed else own
        by_lang.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, other))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels_of([r[2] for r in sorted(by_lang[x])]) for x in langs}
    top = levels_of([trees[x][-1][0] for x in langs])
    root, out = top[-1][0] if langs else None, []
    for i, lang in enumerate(langs):
        for pos, (known, doc_id, own, other) in enumerate(sorted(by_lang[lang])):
            path = siblings(trees[lang], pos) + siblings(top, i)
            node = other
            for before, after in path:
                node = h(*before, node, *after)
            proof = h(*(x for before, after in path for x in before + after))
            out.append((doc_id if known else None, own, trees[lang][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 500, 512])
def test_paths_of_a_block(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = levels_of(leaves)
    assert depth(n) == len(levels) - 1 and block_root(leaves, depth(n)) == levels[-1][0]
    paths = list(auth_paths(leaves, depth(n)))
    assert len(paths) == n
    for pos, path in enumerate(paths):
        assert path == [("".join(a), "".join(b)) for a, b in siblings(levels, pos)]
        assert fold(leaves[pos], path) == levels[-1][0]
        assert cut_path("".join(a + b for a, b in path), pos, n) == path


def test_a_block_with_more_levels_than_it_needs():
    # the last block of a larger tree: runs of one node are hashed too
    assert block_root(["a" * 64], 3) == h(h(h("a" * 64)))
    assert list(auth_paths(["a" * 64], 2)) == [[("", ""), ("", "")]]


def test_like_brute_force(odd_docs, odd_rows, clashing_docs, no_docs):
    want = brute(odd_rows)
    assert found(manifest(odd_docs, picked())) == want
    assert any(not r[-1] for r in want) and any(r[-1] for r in want)
    assert found(manifest(clashing_docs.withColumns({c: F.lit("x") for c in ("tree", "pos", "block", "leaf")}), picked())) == want
    assert manifest(no_docs, picked()).count() == 0
    assert all(r["verified"] for r in manifest(odd_docs).collect())


@pytest.mark.parametrize("levels", [1, 2])
def test_many_blocks(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rnd = random.Random(8)
    langs = [None, "", "de", "é", *(f"l{i}" for i in range(15))]
    rows = [(i, rnd.choice(["Abc", "abc", None, "", "É x"]), rnd.choice(["de"] * 20 + langs), rnd.choice(["s", None]), 3) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert found(manifest(docs, picked())) == brute(rows)


def test_registered_query(spark, tmp_path, odd_docs, odd_rows):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert found(op12_merkle_manifest(spark, str(tmp_path))) == brute(odd_rows)
