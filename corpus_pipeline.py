"""Training-data pipeline: STAGES over the documents table, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents. Toxicity learns its grades from the labels beside the documents; the last
stage encodes each text and decodes it again, and gives the digest of the decoded text beside the tokens.

Defined results: null and empty texts are clean, equal each other (of them the largest id stays) and have
no tokens; rows with a null id pass every stage like others; repeated rows are copies, of which one stays;
of near copies one document stays; the mix takes no row more than three times and leaves out what is over
its source's target; extra columns of documents travel along, also under names that a stage uses itself;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costframe.llm import exact_dedup, jaccard_join, merge_dropout, mixing, severity
from costframe.llm.common import documents, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return severity.without_toxic(docs, severity.train(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return merge_dropout.encode(docs, decoded=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: Fitted grades, near duplicates and tokens have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{i}")
    return docs
