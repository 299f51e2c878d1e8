"""The corpus pipeline: quality classifier, quality rules, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents. ``run`` writes every stage's rows to the shared folder and reads
them back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sunframe.llm.classifier import keep_good
from sunframe.llm.common import table, written
from sunframe.llm.packing import pack
from sunframe.llm.rules import keep_by_rules
from sunframe.llm.secrets import redact_secrets
from sunframe.llm.similar import drop_similar


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; labels of held-out rows stay unseen."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the risk-controlled cutoffs reject go."""
    return keep_by_rules(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id: five-word shingles, similarity 0.8."""
    return drop_similar(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row a piece."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("best-fit packing", packing),
]

#: SQL cannot express the models, hashes and the packing; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
