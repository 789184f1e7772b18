"""Training corpus from documents: good text, kept by the rules, one of each near-duplicate group, free of benchmark items, encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; run() writes every stage to the shared folder and
reads it again, so a lost executor repeats one stage at most. All stages but the last return the columns of documents as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowmill.llm import bpe, decontamination, near_dedup, quality_classifier, quality_rules
from rowmill.llm.common import find_package, table
from rowmill.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; trained on the labelled ones among them."""
    return quality_classifier.keep_good(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and all rules."""
    find_package(spark)
    return quality_rules.keep_passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that of the least doc_id."""
    find_package(spark)
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the kept documents."""
    import public_tokenizers

    find_package(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"], ids=False, digests=True)


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", encode),
]

#: The classifier and the fingerprints have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
