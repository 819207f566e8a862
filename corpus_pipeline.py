"""Corpus pipeline over ``documents``: quality, exact and near duplicates, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.  All but
the last return the columns of ``documents``; the last returns doc_id, source, n_tokens and ids.

Nulls, empty texts, ties, repeated rows, empty tables and further columns are treated as the
operators' modules say: a null or empty text fails the quality rules, of several equal rows the exact stage
keeps one, and a document that the mix repeats has a row per copy from then on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import exact_dedup, mixing, near_dedup, quality, sentencepiece_scan
from skyledger.llm.common import documents, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that a rule rejects go."""
    return quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the first of equal texts stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4 on five-word shingles: the first document of each group stays."""
    return near_dedup.keep_first(docs, width=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: token ids of every document."""
    found = sentencepiece_scan.encode(docs, ["doc_id", "source"])
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("minhash_near_dedup", near), ("mixing", mix), ("sentencepiece", tokens)]

#: Histogram distances, min-max signatures and segmentation have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
