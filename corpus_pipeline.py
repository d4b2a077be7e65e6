"""A training corpus from ``documents``: filter, deduplicate, decontaminate, redact, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents; stages only drop rows or, for secrets, replace spans of text
(n_chars follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontamination, ngram_join, packing, quality_classifier, secret_scan
from lakeloom.llm.common import discard, small_batches, stored, table
from lakeloom.llm.queries import tokenizer_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; fitted on the labels of these documents."""
    labels = table(spark, sf_dir, "labels")
    return quality_classifier.accepted(docs, quality_classifier.fit_quality(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return ngram_join.without_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced."""
    small_batches(spark)
    clean = secret_scan.redacted(docs, secret_scan.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    small_batches(spark)
    return packing.pack_documents(docs, *tokenizer_files())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminated),
          ("secrets", secrets), ("packing", packed)]

#: SQL can express neither the classifier nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has read is removed once its own rows are written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
