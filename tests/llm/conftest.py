import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rnd = random.Random(5)
    return ["".join(rnd.choice("abcdefghijklmnoprstuv") for _ in range(rnd.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rnd = random.Random(6)
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base = [prose(rnd.randint(3, 300)) for _ in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    rows += [
        (100, None, "en", "s", None), (101, "", None, None, 0), (102, "   \n ", "en", "s", 5), (103, "é" * 5, "fr", "s", 5),
        (104, base[0].upper(), "en", "s", 1), (105, base[0], "en", None, 1), (105, base[0], "en", None, 1), (105, base[1], "en", "s", 1),
        (None, base[2], "en", "s", 1), (106, prose(30_000), "en", "s", None), (107, "!!! 123", "en", "s", 7),
        (108, "Ünï \U0001f642 <|endoftext|> 你好  x", None, "s", 3), (109, base[3] + " tail", "en", "s", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    """Extra columns under names that operators use."""
    from pyspark.sql import functions as F

    names = ["text_sha256", "_maybe", "_row", "kept", "lang_pred", "score", "key", "ids", "fp", "shard", "_doc", "text_hash", "component_id", "_run", "n"]
    return odd_docs.withColumns({n: F.lit("x") for n in names})
