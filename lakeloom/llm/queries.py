"""Registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import packing, pii, quality_classifier, quality_rules, secret_scan, sharding, toxicity, url_filter
from lakeloom.llm.collocations import SQL_COLLOCATIONS, collocations
from lakeloom.llm.common import stored, table
from lakeloom.llm.decontamination import decontaminate
from lakeloom.llm.line_dedup import SQL_LINE_DEDUP, dedup_lines
from lakeloom.llm.ngram_join import ngram_jaccard_join
from lakeloom.llm.spelling_variants import spelling_variants


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *tokenizer_files())


def tokenizer_files() -> tuple[str, str, str]:
    """Paths of the public vocabulary (as tokenizer and as ranks) and its pattern."""
    import public_tokenizers as files
    return files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, labels))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_classifier.quality_scores(docs, quality_classifier.fit_quality(docs, labels))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept", "failures", "policy")


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents, stored once, under every policy: what each rule rejects and what it alone rejects."""
    ledger = stored(quality_rules.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    out = [quality_rules.ablations(ledger, version).withColumn("policy", F.lit(version)) for version in sorted(quality_rules.POLICIES)]
    return functools.reduce(DataFrame.unionByName, out)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_model")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).drop("kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard_join, op2_packing, op3_toxicity, op4_quality_classifier,
                            op5_secret_scan, op6_quality_rules, op7_decontamination, op8_pii,
                            op9_url_filter, op10_sharding, op11_collocations, op12_spelling_variants,
                            op13_line_dedup, quality_rule_ablations)}

ORACLE: dict[str, str] = {"op11_collocations": SQL_COLLOCATIONS, "op13_line_dedup": SQL_LINE_DEDUP}
