import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import bpe_lexicon as B

PATH = B.vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    split = B.WordSplitter(PATH)
    return B.Codec(PATH, B.compile_lexicon({w: split.merge(w) for w in ("the", "of", "thee", "bee", "lee", "'s", "été", "2")}))


def test_automaton_shares_suffixes_and_finds_words():
    words = {w: [i, i + 1][: i % 3] for i, w in enumerate(["tap", "taps", "top", "tops", "a", "été", "x" * 50])}
    lexicon = B.Lexicon(B.compile_lexicon(words))
    for w, ids in words.items():
        n = int(lexicon.find([w])[0])
        assert lexicon.ids[lexicon.start[n] : lexicon.start[n + 1]].tolist() == ids
    asked = ["tap", "ta", "", "tapsy", "zz", "top", "été"]
    assert (lexicon.find(asked) >= 0).tolist() == [True, False, False, False, False, True, True]
    # tap/top and taps/tops share all that follows their second letter
    small = B.Lexicon(B.compile_lexicon({w: [1] for w in ("tap", "taps", "top", "tops")}))
    assert len(small.final) == 5
    empty = B.Lexicon(B.compile_lexicon({}))
    assert empty.find(["a", ""]).tolist() == [-1, -1]


@given(st.text(max_size=60) | st.text(alphabet="the 'sédon12<|>\xa0İΣς́ ", max_size=60))
@settings(max_examples=400, deadline=None)
def test_like_the_tokenizer(codec, text):
    t = codec.split.tokenizer
    want = t.encode(text, add_special_tokens=False).ids
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert codec.decode(ids) == t.decode(want, skip_special_tokens=False)


def same_as_tokenizer(codec, texts):
    t = codec.split.tokenizer
    for text, want in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
        assert codec.decode(ids) == t.decode(want.ids, skip_special_tokens=False), text


def test_every_latin_character(codec):
    """Alone, before and after letters, digits, signs and white space."""
    around = ("{}", "ab{}cd", "{}x", "1{}2", "!{}?", "{0}{0}", "{}'s", "'{}", "É{} ö", "{}\n{}")
    same_as_tokenizer(codec, [a.format(chr(c), chr(c)) for c in range(1, 0x250) for a in around])


def test_many_latin_texts(codec):
    rnd = random.Random(3)
    latin, common = [chr(c) for c in range(1, 0x250)], "abc DEF'123.,stmdrel ƁƆƉƊƏƐƓƔƖƗƜƝƟƦƩƮƱƲƷȺȾɄɅ\n"
    texts = ["".join(rnd.choice(latin if rnd.random() < 0.3 else common) for _ in range(rnd.randint(1, 60))) for _ in range(10_000)]
    same_as_tokenizer(codec, [*texts, "Ɓala Ɗan", "Ɖekawo"])


def test_long_words_are_forgotten_too(codec, monkeypatch):
    monkeypatch.setattr(B, "FLUSH_CHARS", 40)
    same_as_tokenizer(codec, ["x" * n + " the y" for n in range(1, 60)] * 2)
    assert codec.known_chars < 200


def test_documents(odd_docs, odd_rows, clashing_docs, no_docs, codec, monkeypatch):
    t = codec.split.tokenizer
    want = []
    for d, text, *_ in odd_rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((d, len(ids), np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False)))
    compiled = B.build_lexicon(odd_docs, PATH, 100)
    for docs in (odd_docs, clashing_docs):
        got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in B.encoded(docs, PATH, compiled).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    monkeypatch.setattr(B, "FLUSH_CHARS", 100)  # tasks hand on sums sooner
    assert B.build_lexicon(odd_docs, PATH, 100) == compiled
    digests = B._coded(odd_docs, PATH, compiled, digests=True).collect()
    assert sorted(r["ids_sha256"] for r in digests) == sorted(hashlib.sha256(w[2]).hexdigest() for w in want)
    assert B.encoded(no_docs, PATH, B.build_lexicon(no_docs, PATH)).count() == 0


def test_frequent_words(spark):
    counts = spark.createDataFrame([(f"w{i}", 1000 // (i + 1)) for i in range(200)], "word string, n long")
    found = B.frequent_words(counts, 20)
    assert 10 <= len(found) <= 20 and set(found) == {f"w{i}" for i in range(len(found))}
    assert B.frequent_words(counts.limit(0), 20) == []


def test_forgetting_words_changes_nothing(codec, monkeypatch):
    monkeypatch.setattr(B, "FLUSH_WORDS", 3)
    text = "the quick brown fox jumps over the lazy dog"
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == codec.split.tokenizer.encode(text, add_special_tokens=False).ids
