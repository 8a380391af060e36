"""A training corpus from `documents` in five stages, each written as Parquet and read by the next.

Language ID drops texts that are in no learned language; exact dedup keeps one row of equal texts;
the n-gram Jaccard join keeps one document of each group of near duplicates; the secret scan
replaces credentials in the texts; best-fit packing assigns all that is left to sequences.

Defined cases: a null text, an empty one or one without a letter is in no language and goes at the first stage; without a
single labelled row nothing is refused there. A row without an id stays unless its text equals another's. Of equal texts the
longest original stays, then the one of the smallest id; rows that repeat an id and a text are copies, rows that repeat an id
with different texts are one document to the Jaccard join. Texts of any length are read whole. An empty table gives an empty
result with the same columns. Other columns are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, jaccard, langid, packing, secret_scan
from ledgerloom.llm.common import materialize, prepare, read_table

#: Below this mean probability of the best language a text counts as being in none.
LEAST_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters or a confident language; all columns stay."""
    prepare(spark)
    return langid.keep_languages(docs, langid.train(langid.labelled_sample(docs)), LEAST_LANGUAGE_SCORE)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays."""
    prepare(spark)
    gone = jaccard.near_duplicates(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; reported spans are replaced in its text and its length follows."""
    prepare(spark)
    return secret_scan.redact_secrets(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packed),
]

#: No SQL: a trained network, a sampled seed and a packing plan are not expressible. Tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
