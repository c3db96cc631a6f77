import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lotwise.llm import divergence
from lotwise.llm.divergence import radix_top, source_divergence
from lotwise.llm.shared import materialized

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def brute(rows, top=200, least=3):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source, *_ in rows]
    df, n_lang, n_group = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        n_lang[lang].update(terms)
        n_group[lang, source].update(terms)
    out = []
    p = lambda n, total, v: 1 + 10**9 * (n + 1) // (total + v)
    f = lambda a, b: (a - b) ** 2 // b
    key = lambda x: (-x[1], x[0].encode())
    for lang, source in n_group:
        kept = [t for t, n in df[lang].items() if n >= least]
        scores = {}
        for g in [s for name, s in n_group if name == lang]:
            total = sum(n_group[lang, g][t] for t in kept)
            scores[g] = {t: p(n_group[lang, g][t], total, len(kept)) for t in kept}
        whole = sum(n_lang[lang][t] for t in kept)
        own = scores[source]
        pairs = [(g, sum(f(own[t], q[t]) for t in kept)) for g, q in scores.items() if g != source]
        base = {t: p(n_lang[lang][t], whole, len(kept)) for t in kept}
        terms = [(t, f(own[t], base[t])) for t in kept if n_group[lang, source][t] and own[t] > base[t]]
        out += [(lang, source, "pair", i, v, r) for r, (i, v) in enumerate(sorted(pairs, key=key), 1)]
        out += [(lang, source, "term", i, v, r) for r, (i, v) in enumerate(sorted(terms, key=key)[:top], 1)]
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    words = [rnd.choice("abcé") * rnd.randint(1, 3) + rnd.choice(["", "x", "Y", "ñ", "你"]) for _ in range(60)]
    out = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) + " 12,x_y", rnd.choice(["en", "fr", None, ""]), rnd.choice(["a", "b", "é", None, "hot", "hot", "hot"]), 1) for i in range(150)]
    return out + [(900, None, "de", "a", 1), (901, "", "de", "b", 1), (902, "once only", "de", "c", 1), (903, "..", None, None, None), (None, "aa b", "en", "a", 1), (904, "w " * 9000, "en", "long", 1)]


def test_like_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert found(source_divergence(docs)) == brute(rows)


def test_odd_clashing_and_empty(odd_docs, odd_rows, clashing_docs, no_docs):
    assert found(source_divergence(odd_docs, top=5)) == brute(odd_rows, top=5)
    extra = clashing_docs.withColumns({c: F.lit("x") for c in ("term", "p", "of", "gid", "rank", "value")})
    assert found(source_divergence(extra, top=3, least_docs=1)) == brute(odd_rows, top=3, least=1)
    assert source_divergence(no_docs).count() == 0


def test_few_held_at_a_time(spark, rows, monkeypatch):
    for name, value in (("HELD_TERMS", 7), ("TILE", 2), ("HELD_TILES", 1), ("FINISH", 2)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    assert found(source_divergence(docs, top=4)) == brute(rows, top=4)


@pytest.mark.parametrize("finish", [1, 3, 10_000])
def test_radix_selection(spark, finish):
    rnd = random.Random(4)
    rows = [("ties", 5, "same" * 20 + format(i, "b")) for i in range(700)] + [("ties", 9, "up"), ("ties", 1, "down")]
    rows += [("wide", rnd.choice([0, 1, 1 << 59, (1 << 59) + 1, rnd.randint(0, 1 << 60)]), f"é{i}") for i in range(700)]
    rows += [("prefixes", 0, "a" * i) for i in range(1, 60)] + [("few", 3, "x"), ("few", 3, "")]
    df = materialized(spark.createDataFrame(rows, "g string, v long, i string").repartition(3))
    got = sorted((r["g"], r["rank"], r["v"], r["i"]) for r in radix_top(df, ["g"], "v", "i", 40, finish).collect())
    want = []
    for g in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))
        want += [(g, n, v, i) for n, (_, v, i) in enumerate(order[:40], 1)]
    assert got == sorted(want)
