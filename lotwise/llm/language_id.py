"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams are summed by Spark for each language; the log-probability
matrix (languages x BUCKETS, float32) is broadcast, and tasks score whole texts in
batches: each n-gram is a sparse index into the matrix, summed by document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced, table

#: Lengths of the n-grams, and hash buckets for all of them.
GRAMS = (1, 2, 3)
BUCKETS = 1 << 16
#: Bound of the training sample: about so many labelled rows of each language.
ROWS_PER_LANG = 2000
#: Languages a model may have; more is taken for a wrong label column.
MAX_LANGS = 1000
SMOOTHING = 0.5
#: Values of the hash that draws the sample.
HASHES = 1 << 62
#: Code points counted or scored at a time.
CHUNK = 1 << 20

_LETTER = regex.compile(r"\p{L}")


_RUNS = regex.compile(r"[^\p{L}\p{M}]+")


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; all but letters are one space, one at either end too."""
    return np.frombuffer(f" {_RUNS.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def _features(c: np.ndarray, at: int, end: int) -> np.ndarray:
    """Bucket of every n-gram of code points that begins from `at` to before `end`."""
    found = []
    for n in GRAMS:
        stop = min(end, len(c) - n + 1)
        if stop > at:
            h = c[at:stop].astype(np.uint64) + np.uint64(n << 21)
            for k in range(1, n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + c[at + k : stop + k]
            h = h * np.uint64(0xD6E8FEB86659FD93)
            found.append((h >> np.uint64(64 - 16)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _chunks(text: str):
    """The features of a text, CHUNK code points at a time; each n-gram is in one chunk."""
    c = _letters(text)
    for at in range(0, len(c), CHUNK):
        yield _features(c, at, at + CHUNK)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows the model may learn from: non-null lang, crc32(doc_id as text) mod 4 is not 2."""
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (_fold() != 2))


def _fold():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4, F.lit(0))


def threshold(rows_per_lang: int, n: int) -> int:
    """A hash below HASHES is below this one with the chance rows_per_lang / n; never 0, however large n is."""
    return HASHES * min(rows_per_lang, n) // n


def train(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probability matrix (with the prior in a last column).

    The sample takes each labelled row with the chance rows_per_lang / rows of its
    language, by a hash of doc_id and text, and reads those texts whole. Priors come from
    all labelled rows. With no labelled rows there are no languages.
    """
    spark = docs.sparkSession
    labelled = training_rows(docs)
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(totals) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = sorted(totals)
    if not langs:
        return [], np.zeros((0, BUCKETS + 1), np.float32)
    chance = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, threshold(rows_per_lang, n))])
    sample = labelled.filter(F.xxhash64("doc_id", "text").bitwiseAND(F.lit(HASHES - 1)) < chance[F.col("lang")])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in sliced(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                for f in _chunks(text):
                    sums[lang] += np.bincount(f, minlength=BUCKETS)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["lang", "counts"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
        return pd.DataFrame({"lang": pdf["lang"][:1], "counts": [total.tobytes()]})

    # the sample is bounded, so a few partitions hold it and merge() gets a few vectors
    parts = min(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counted = sample.select("lang", "text").repartition(parts).mapInArrow(count, "lang string, counts binary")
    sums = {r["lang"]: np.frombuffer(r["counts"], np.int64) for r in counted.groupBy("lang").applyInPandas(merge, "lang string, counts binary").collect()}
    matrix = np.zeros((len(langs), BUCKETS + 1), np.float32)
    for i, lang in enumerate(langs):
        n = sums.get(lang, np.zeros(BUCKETS, np.int64)) + SMOOTHING
        matrix[i, :BUCKETS] = np.log(n / n.sum())
        matrix[i, BUCKETS] = np.log(totals[lang] / sum(totals.values()))
    return langs, matrix


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray) -> DataFrame:
    """docs with lang_pred and score.

    score is the language's posterior with log-likelihoods divided by the square root of
    the number of n-grams, so that long texts do not all score exactly 1. `und` with score
    0: the text is null or has no letter, or there is no language. Ties go to the first
    language in order. Texts are read whole. docs keeps its other columns, of any names;
    columns named lang_pred or score are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((langs, np.ascontiguousarray(matrix.T)))

    @F.pandas_udf("struct<lang_pred string, score double>")
    def score(text: pd.Series) -> pd.DataFrame:
        names, weights = shared.value
        pred, scores = [], []
        for t in text:
            if t is None or not names or not _LETTER.search(t):
                pred.append("und")
                scores.append(0.0)
                continue
            total, n = weights[BUCKETS].astype(np.float64), 0
            for f in _chunks(t):
                used = np.bincount(f, minlength=BUCKETS) if len(f) > BUCKETS else None
                total = total + (used @ weights[:BUCKETS] if used is not None else weights[f].sum(axis=0, dtype=np.float64))
                n += len(f)
            best = int(np.argmax(total))
            pred.append(names[best])
            scores.append(float(1 / np.exp(np.minimum(50, (total - total[best]) / max(1, n) ** 0.5)).sum()))
        return pd.DataFrame({"lang_pred": pred, "score": scores})

    others = [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(F.struct(*others).alias("_doc"), score("text").alias("_lang")).select("_doc.*", "_lang.lang_pred", "_lang.score")


def op2_naive_bayes_lang(spark, sf_dir):
    """The language of every whole text, learned from the labels of three folds of four; null text is `und`."""
    docs = table(spark, sf_dir, "documents")
    langs, matrix = train(docs)
    scored = predict(docs.select("doc_id", "text"), langs, matrix)
    return scored.select("doc_id", (_fold() == 2).alias("held_out"), "lang_pred", "score")
