"""The pipeline on a small corpus: each stage against brute force on its own input, and run() end to end."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .conftest import SCHEMA
from .test_packing import check, reference_ids  # noqa: F401
from .test_simhash import near_brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus():
    """Two languages, exact copies, near copies, and texts without a letter."""
    rnd = random.Random(21)
    sounds = {"xx": "aeioulmnr", "yy": "kstzwbgdp"}
    words = {k: ["".join(rnd.choice(s) for _ in range(rnd.randint(2, 8))) for _ in range(300)] for k, s in sounds.items()}
    say = lambda lang, n: [rnd.choice(words[lang]) for _ in range(n)]
    texts = []
    for i in range(60):
        lang = "xx" if i % 2 else "yy"
        base = say(lang, rnd.randint(20, 200))
        texts.append((" ".join(base), lang))
        if i % 4 == 0:
            texts += [(" ".join(base), lang), (" ".join(base).upper(), None)]
        if i % 5 == 0:
            for _ in range(3):
                edited = list(base)
                edited[rnd.randrange(len(edited))] = "new"
                texts.append((" ".join(edited), lang))
    texts += [(None, "xx"), ("", "xx"), ("123 !!! 456", "yy"), ("  \n", None)]
    return [(i, t, lang, "s", None) for i, (t, lang) in enumerate(texts)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def exact_brute(rows):
    last = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        last[(r[1] or "").translate(LOWER)] = r[:2]
    return set(last.values())


def test_each_stage_and_the_whole(spark, sf_dir, reference_ids):  # noqa: F811
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, pairs = docs.columns, lambda df: {(r["doc_id"], r["text"]) for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "packing"]

    clear = stages["language_id"](spark, docs, sf_dir)
    with_letters = {(d, t) for d, t, *_ in corpus() if t and any(c.isalpha() for c in t)}
    assert clear.columns == columns and pairs(clear) == with_letters

    distinct = stages["exact_dedup"](spark, clear, sf_dir)
    want = exact_brute(with_letters)
    assert distinct.columns == columns and pairs(distinct) == want

    apart = stages["near_dedup"](spark, distinct, sf_dir)
    want = set(near_brute(sorted(want)))
    assert apart.columns == columns and pairs(apart) == want

    pieces = stages["packing"](spark, apart, sf_dir).collect()
    check(pieces, sorted(want), reference_ids, 2048)
    found = corpus_pipeline.run(spark, sf_dir).collect()
    check(found, sorted(want), reference_ids, 2048)


def test_odd_documents_through_the_stages(spark, odd_docs, odd_rows, clashing_docs):
    """Nulls, repeated rows, long texts and clashing names; each stage on all its predecessor kept."""
    docs = clashing_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        docs = stage(spark, docs, "").checkpoint()
        after = {(r["doc_id"], r["text"]) for r in docs.collect()}
        assert docs.columns == clashing_docs.columns and after <= before
        if name == "language_id":
            assert after >= {(d, t) for d, t in before if d in (103, 106, 109)} and (100, None) not in after
        elif name == "exact_dedup":
            assert after == exact_brute(before)
        else:
            assert after == set(near_brute(sorted(before, key=str)))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_no_documents(spark, no_docs, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, no_docs, "").count() == 0


def test_without_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.identify_language(spark, docs, sf_dir)
    assert out.count() == sum(any(c.isalpha() for c in r[1] or "") for r in corpus())
