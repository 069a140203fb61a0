"""A training corpus from raw documents, in five stages; each stage's rows are written as Parquet and reread.

A stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cellpulse.llm import bpe, decontaminate, paragraphs, simhash, toxicity
from cellpulse.staging import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on their labels, doesn't reject."""
    classifier = toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.rejected_removed(docs, classifier)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of linked fingerprints."""
    return simhash.near_duplicates_removed(docs)


def without_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of repeated paragraphs only the first occurrence stays in `text`."""
    return paragraphs.duplicates_removed(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.leaking_removed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    ranks = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("substring_dedup", without_repeated_paragraphs),
    ("benchmark_decontamination", without_benchmark),
    ("byte_level_bpe", tokens),
]

#: No stage can be expressed in SQL. Tests compare what the stages call with brute force (toxicity: with labels).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents of `sf_dir` that all stages keep; each stage's rows are written, and
    the next one reads them. Nulls, empty and repeated rows and empty tables pass as every stage's docstring says."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
