"""A corpus pipeline: language ID, exact dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. A caller may write each
stage's result and give what it reads back to the next; run() does so in the shared
folder. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import exact_dedup, language_id, near_dedup, packing
from lotwise.llm.shared import materialized, table

#: A document stays if its language has at least this score.
MIN_LANG_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those whose language stays unclear.

    Without any label there is no language to tell, and only the first kind goes.
    """
    langs, matrix = language_id.train(docs)
    if not langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    scored = language_id.predict(docs.select(F.struct("*").alias("_doc"), "text"), langs, matrix)
    return scored.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANG_SCORE)).select("_doc.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the one with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group at similarity 0.8 over five-word shingles one document stays."""
    return near_dedup.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token windows, filled by BM25 neighbours."""
    return packing.packed(docs, with_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained scores and greedy packing are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
