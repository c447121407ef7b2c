"""Registered queries of this package: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from costframe.llm import (alignment, exact_dedup, jaccard_join, merge_dropout, mixing, oracle, packing, quality, secrets, severity,
                           sketches, suffix_dedup, variants, window_dedup)
from costframe.llm.common import documents


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix of all documents: sizes, targets, words taken, and the output shards of every copy."""
    plan = mixing.plan_mix(documents(spark, sf_dir))
    return plan.selectExpr("doc_id", "size", "source_size", "target", "taken", "array_join(shards, ',') AS shards")


def op2_toxicity_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, grade and verdict of every document."""
    scored = severity.score(documents(spark, sf_dir).select("doc_id", "text"), severity.train(spark, sf_dir))
    return scored.select("doc_id", "severity", "p_toxic", "grade", "toxic")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: a first delivery (the lower half of the ids) is scanned into a written
    ledger, then the whole table is scanned against it, so only unseen texts are read by the rules again."""
    docs = documents(spark, sf_dir)
    middle = docs.selectExpr("min(doc_id) / 2 + max(doc_id) / 2").scalar()
    return secrets.scan_report(docs, secrets.scan_in_steps([docs.where(F.col("doc_id") <= middle)]))


def op4_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a model that never saw the held-out ids."""
    scored = quality.score(documents(spark, sf_dir).select("doc_id", "text"), quality.train(spark, sf_dir))
    return scored.selectExpr("doc_id", f"coalesce({quality.HELD_OUT}, false) AS held_out", "score",
                             f"CAST(score >= {quality.GOOD_FROM} AS int) AS predicted")


def op5_document_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraph sketches of every text and its edited text, and how alike they are."""
    return sketches.fingerprints(documents(spark, sf_dir), cut=sketches.passages)


def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document left when 13-word windows of smaller ids are removed."""
    return window_dedup.window_report(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts: which row stays."""
    return exact_dedup.duplicate_groups(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document left when every 200-byte string that starts twice is removed."""
    return suffix_dedup.byte_report(documents(spark, sf_dir), keep="none")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    return jaccard_join.component_report(documents(spark, sf_dir))


def op10_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the SHA-256 of the text decoded from them."""
    return merge_dropout.token_report(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return variants.variant_groups(documents(spark, sf_dir))


def op12_square_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.packed(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of byte-level and piece tokens of every document, and corpus counts of their links."""
    return alignment.align(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_source_mix, op2_toxicity_grades, op3_secret_scan, op4_quality_score, op5_document_sketch, op6_window_dedup,
    op7_exact_dedup, op8_suffix_dedup, op9_jaccard_join, op10_merge_dropout, op11_spelling_variants, op12_square_packing,
    op13_token_alignment)} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL: dict[str, str] = dict(oracle.SQL)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
